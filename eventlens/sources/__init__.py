"""Where rows come from: the bus, landed documents, the sinks."""
