"""What a deployment decides, in four groups: the bus, the sinks, the tables, the pair join.

``Settings.read`` takes them from variables named in ``VARIABLES``. A variable with the prefix that
is not in that list, or whose text does not fit, is an error that names it, so a misspelt setting
cannot pass unseen. ``on`` checks the folders against the master of the running session: off a
local master every folder has to be one that all executors see.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

PREFIX = "EVENTLENS_"
# Event topics, without dead letters; the bus matches a pattern against whole names.
EVENT_TOPICS = r"events\.(?!.*\.dlq$).*"
RAW, PAIRS = "events_raw", "correlated"

_UNITS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000,
          "day": 86_400_000, "week": 604_800_000}
_PART = re.compile(rf"(\d+)\s*({'|'.join(_UNITS)})s?", re.IGNORECASE)


def window_ms(text: str) -> int:
    """Milliseconds of an interval such as ``1 hour 30 minutes``; units of fixed length only.

    What passes may stand inside an INTERVAL literal.
    """
    parts = _PART.findall(text)
    if not parts or _PART.sub("", text).strip():
        raise ValueError(f"not a fixed-length interval: {text!r}")
    return sum(int(n) * _UNITS[unit.lower()] for n, unit in parts)


@dataclass(frozen=True)
class Bus:
    servers: str = "localhost:9092"
    topics: str = EVENT_TOPICS
    start: str = "latest"
    # Rows in one batch of a stream, over all topics; with "earliest" the first batch would
    # otherwise be all the bus holds.
    batch_rows: int = 2_000_000
    # Tasks that read the topics, where topics have fewer partitions than that; 0: as they are.
    tasks: int = 0


@dataclass(frozen=True)
class Sinks:
    root: str = ""
    checkpoints: str = ""
    trigger: str = ""
    # Files a stream writes for each partition and batch, one task each.
    files: int = 4

    def place(self, name: str) -> str:
        if not self.root:
            raise ValueError(f"set {PREFIX}SINKS to the folder of the sinks")
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self.place(RAW)

    @property
    def pairs(self) -> str:
        return self.place(PAIRS)

    @property
    def checkpoint_root(self) -> str:
        return self.checkpoints.rstrip("/") or self.place("checkpoints")


@dataclass(frozen=True)
class Tables:
    hive: bool = False
    metastore: str = ""
    # A database of the deployment's own for its two tables; without one they are in the current one.
    database: str = ""
    # Where the metastore sees the sinks, if it names their file system otherwise.
    root: str = ""
    repair_seconds: int = 30


@dataclass(frozen=True)
class Join:
    window: str = "10 minutes"
    # Rows of an entity named as hot are spread over grid x grid state partitions.
    hot_grid: int = 8
    hot_entities: tuple[str, ...] = ()


@dataclass(frozen=True)
class Settings:
    bus: Bus = field(default_factory=Bus)
    sinks: Sinks = field(default_factory=Sinks)
    tables: Tables = field(default_factory=Tables)
    join: Join = field(default_factory=Join)

    @classmethod
    def read(cls, env: Mapping[str, str]) -> Settings:
        groups: dict[str, dict] = {"bus": {}, "sinks": {}, "tables": {}, "join": {}}
        for name, text in env.items():
            if not name.startswith(PREFIX):
                continue
            if name not in VARIABLES:
                raise ValueError(f"unknown setting {name}; known: {', '.join(VARIABLES)}")
            group, key, read = VARIABLES[name]
            try:
                groups[group][key] = read(text.strip())
            except ValueError as err:
                raise ValueError(f"{name}: {err}") from None
        return cls(Bus(**groups["bus"]), Sinks(**groups["sinks"]), Tables(**groups["tables"]),
                   Join(**groups["join"]))

    @classmethod
    def at(cls, root: str) -> Settings:
        """Defaults, with the sinks below ``root``."""
        return cls(sinks=Sinks(root))

    def moved(self, root: str) -> Settings:
        return replace(self, sinks=replace(self.sinks, root=root))

    def on(self, master: str) -> Settings:
        """These settings, once their folders suit ``master``."""
        if master == "local" or master.startswith("local["):
            return self
        for name, path in (("SINKS", self.sinks.root), ("CHECKPOINTS", self.sinks.checkpoint_root)):
            # Without a scheme a path belongs to the cluster's default file system.
            if not path or path.startswith("file:"):
                raise ValueError(f"{PREFIX}{name} has to name a folder that all executors share, "
                                 f"not {path!r}")
        return self

    def table_place(self, name: str) -> str:
        """A table's folder: the sink's, in the metastore's terms."""
        return f"{self.tables.root.rstrip('/')}/{name}" if self.tables.root else self.sinks.place(name)


def session(builder: SparkSession.Builder, settings: Settings) -> SparkSession:
    """The jobs' session. Master and resources are those the application was submitted with."""
    builder = builder.config(map={
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    })
    if settings.tables.metastore:
        builder = builder.config("hive.metastore.uris", settings.tables.metastore)
    if settings.tables.hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def _count(least: int) -> Callable[[str], int]:
    def read(text: str) -> int:
        if (n := int(text)) < least:
            raise ValueError(f"{n} is below {least}")
        return n

    return read


def _yes_no(text: str) -> bool:
    if text not in ("true", "false"):
        raise ValueError(f"{text!r} is neither true nor false")
    return text == "true"


def _database(text: str) -> str:
    if text and not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", text):
        raise ValueError(f"{text!r} is no plain database name")
    return text


def _interval(text: str) -> str:
    window_ms(text)
    return text


def _names(text: str) -> tuple[str, ...]:
    return tuple(n for n in (part.strip() for part in text.split(",")) if n)


#: Variable -> group, setting, how its text is read.
VARIABLES: dict[str, tuple[str, str, Callable]] = {PREFIX + name: rest for name, rest in {
    "BUS": ("bus", "servers", str),
    "TOPICS": ("bus", "topics", str),
    "START": ("bus", "start", str),
    "BATCH_ROWS": ("bus", "batch_rows", _count(1)),
    "BUS_TASKS": ("bus", "tasks", _count(0)),
    "SINKS": ("sinks", "root", str),
    "CHECKPOINTS": ("sinks", "checkpoints", str),
    "TRIGGER": ("sinks", "trigger", str),
    "FILES": ("sinks", "files", _count(1)),
    "HIVE": ("tables", "hive", _yes_no),
    "METASTORE": ("tables", "metastore", str),
    "DATABASE": ("tables", "database", _database),
    "TABLES": ("tables", "root", str),
    "REPAIR_SECONDS": ("tables", "repair_seconds", _count(0)),
    "WINDOW": ("join", "window", _interval),
    "HOT_GRID": ("join", "hot_grid", _count(1)),
    "HOT_ENTITIES": ("join", "hot_entities", _names),
}.items()}
