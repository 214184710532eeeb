"""Secret scan with a random forest against false positives, in DataFrame functions only.

Candidates are runs of at least 16 token characters, whatever they are made of, and shorter values
that stand assigned to a credential's name. Each gets features: length, transitions (between character
classes, and how many neighbouring letters are common together in words), shares of kinds of
characters, coverage by dictionary words, kind of path (the source's name), words before and behind. A
random forest decides which candidates are secrets; only those are findings.

The forest is trained on labelled findings: (candidate, before, after, path, label) rows. Those given
here are made from ``SHAPES``, a list of ways secrets and harmless strings are written, each with many
seeded fillings; what a row is follows from the shape it was made from and from none of the features.
Callers may give findings of their own instead; of these at most ``max_labelled`` are used, the smallest
by a seeded hash. All candidates of all documents are judged, by the same forest on every table.

Defined results: null and blank texts have no candidates; a null source is the path ''; repeated
rows are scanned each; texts are scanned whole; an empty table gives an empty result; other columns
are ignored by ``findings`` and kept by ``redact``.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm.common import fresh, join_rows, materialize

MIN_LENGTH = 16
MIN_ASSIGNED = 8
AROUND = 40
MAX_LABELLED = 20_000
FILLINGS = 60
TREES, DEPTH, SEED = 40, 10, 7
MARK = "[secret]"

NAMES = (r"(?i:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key"
         r"|client[_-]?key|auth(?:orization)?|bearer|credential|_pat)s?")
# A credential's name, the rest of the word it begins, and a sign of assignment.
ASSIGNED = NAMES + r"""[A-Za-z0-9_-]{0,16}["']?\s{0,3}(?:=>|[:=])\s{0,3}["'(]?"""
VALUE = r"""[^\s"'(),;<>]"""
CANDIDATE = (
    # A value behind such a name; the cheap tests come first.
    rf"""(?<=[:=>\s"'(])(?={VALUE}{{{MIN_ASSIGNED}}})(?<={ASSIGNED}){VALUE}{{{MIN_ASSIGNED},}}(?<![.:])"""
    # Or a run of token characters that is no piece of a longer one.
    rf"|(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{{{MIN_LENGTH},}}+={{0,2}}")
HARMLESS = (r"(?i)(?:\b|_)(?:example|sample|test|dummy|placeholder|checksum|commit|revision|sha\d*|md5|etag"
            r"|digest|hash|uuid|guid|card|phone|isbn|base64|order|invoice|batch|version|path|file|see|function)"
            r"(?:\b|_)")
KEY_PREFIX = (r"^(?:AKIA|ASIA|gh[pousr]_|github_pat_|xox[abeprs]-|[sr]k_(?:live|test)_|AIza|glpat-|npm_|pypi-"
              r"|eyJ|ya29|dop_v1_|shp(?:at|ss)_)")
# Common words of prose and of programs.
DICTIONARY = (
    "about", "account", "action", "active", "add", "address", "admin", "after", "all", "and", "any", "app",
    "array", "author", "base", "batch", "before", "between", "body", "build", "button", "cache", "call",
    "change", "char", "check", "class", "click", "client", "code", "color", "column", "command", "comment",
    "commit", "common", "config", "connect", "container", "content", "context", "control", "copy", "core",
    "count", "create", "current", "data", "date", "debug", "default", "delete", "detail", "device", "dir",
    "document", "download", "edit", "element", "enable", "end", "entry", "environ", "error", "event",
    "example", "export", "factory", "feature", "field", "file", "filter", "final", "find", "first", "font",
    "for", "form", "format", "from", "function", "get", "global", "goes", "group", "handler", "has", "header",
    "height", "hello", "here", "home", "host", "image", "import", "index", "info", "init", "input", "insert",
    "item", "java", "key", "kind", "label", "language", "last", "layout", "length", "level", "library",
    "license", "line", "link", "list", "load", "local", "log", "login", "main", "manager", "map", "max",
    "menu", "message", "method", "min", "mode", "model", "module", "name", "new", "next", "node", "not",
    "null", "number", "object", "open", "option", "order", "output", "package", "page", "param", "parent",
    "parse", "password", "path", "plugin", "point", "process", "product", "project", "query", "read",
    "record", "release", "remove", "replace", "report", "request", "required", "resource", "response",
    "result", "return", "sample", "search", "secret", "select", "server", "service", "session", "set",
    "size", "source", "start", "state", "string", "style", "system", "table", "test", "text", "the", "this",
    "time", "token", "type", "update", "user", "value", "version", "view", "with", "your",
)
# Pairs of letters that are common in words of European languages.
PAIRS = ("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de "
         "hi ri ro ic ne ea ra ce li ch ll be ma si om ur el la ei ie ge sc un au qu ue ns os ca us ss ai eu").split()

#: What the marks of a shape stand for.
UNITS = {
    "~": tuple("0123456789abcdef"), "#": tuple("0123456789"), "^": tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "*": tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), "&": tuple("abcdefghijklmnopqrstuvwxyz"),
    "?": tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), "`": tuple("0123456789ABCDEF"),
    "!": tuple("abcdefghjkmnpqrstuvwxyzABCDEFGHJKMNPQRSTUVWXYZ23456789@$%&*!#?+"),
    "@": tuple("the and ing ion ent ver ter ati for ten ich sch ein der que les tion ment res con par ado era ble".split()),
    "|": DICTIONARY, "\u00a4": tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
}
#: (secret or not, before, value, behind, path); ``x{n}`` repeats a mark.
SHAPES = (
    (1, "token = \"", "~{40}", "\"", ""), (1, "TOKEN = \"", "`{40}", "\"", ""), (1, "token: ", "~{32}", " ", "app.yaml"),
    (1, "api_key = '", "~{64}", "'", "settings.py"), (1, "API_KEY=", "*{32}", "\n", "prod.env"),
    (1, "use the key ", "AKIA^{16}", " for the", ""), (1, "", "AKIA^{16}", " was", "notes"),
    (1, "aws_secret_access_key = ", "*{20}/*{10}+*{8}", "\n", "credentials"),
    (1, "and then ", "xoxb-#{12}-#{12}-*{24}", " is", ""), (1, "bot ", "xoxp-#{12}-*{32}", ",", "chat"),
    (1, "GITHUB_PAT=", "ghp_*{36}", "\n", "ci.sh"), (1, "with ", "ghp_*{36}", " in", ""), (1, "", "github_pat_*{22}_*{40}", "", ""),
    (1, "charge ", "sk_live_*{24}", " card", "shop.js"), (1, "maps ", "AIza*{35}", "&", "index.html"),
    (1, "clone ", "glpat-*{20}", "@", ""), (1, "registry ", "npm_*{36}", " ", ""), (1, "Cookie ", "eyJ*{60}", ".", ""),
    (1, "Authorization: Bearer ", "*{40}", "\n", "request.log"), (1, "Authorization: Basic ", "*{38}==", "\n", ""),
    (1, "client_secret_value = '", "*{24}", "'", "auth.rb"), (1, "client_secret: ", "*{10}-*{18}", "\n", "values.yaml"),
    (1, "secret = ", "?{32}", " ", ""), (1, "auth_token: \"", "&{24}", "\"", ""), (1, "secret_key = ", "?{40}", "\n", ""),
    (1, "password: ", "!{13}", "\n", ""), (1, "password = '", "!{10}", "'", "db.py"), (1, "passwd=", "!{16}", " ", "db.cfg"),
    (1, "pwd: ", "!{12}", ",", ""), (1, "DB_PASSWORD=", "!{20}", "\n", ".env"), (1, "the password: ", "&{5}#{4}&{3}", " is", ""),
    (1, "credentials = ", "&{60}#{8}", " ", ""), (1, "private_key: ", "&{300}#{10}", " ", ""), (1, "secret=", "*{60}", " ", ""),
    (1, "api-key: ", "*{16}", " ", ""), (1, "passphrase: ", "?{18}", " ", ""), (1, "access_key ", "*{32}", " ", "notes"),
    (0, "of the ", "@{6}", " and", ""), (0, "to ", "@{8}", ". The", ""), (0, "la ", "@{10}", " que", ""), (0, "", "@{7}-@{3}", " in", ""),
    (0, "call ", "|_|_|_|", "(", "main.py"), (0, "see ", "|/|/|/|", " for", "docs"), (0, "in ", "|-|-|-|", " line", ""),
    (0, "the ", "|_|_version_#", " of", ""), (0, "open ", "/|/|/|/|_##", "", "readme"), (0, "", "@{3}_@{3}_@{2}", " =", ""),
    (0, "token = ", "|_|_|", "(", "views.py"), (0, "password = ", "|.|[|]", "\n", "app.py"), (0, "secret: ", "|_|_|", "\n", "app.yaml"),
    (0, "password: ", "@{4}", " and", ""), (0, "token: ", "@{5}", " in", ""), (0, "the secret: ", "@{3}", " the", ""),
    (0, "api_key = ", "|_|[#]", "\n", ""), (0, "token = \"", "your-|-|-here", "\"", "docs"), (0, "password = ", "changeme", "\n", ""),
    (0, "token = example ", "example-|-value-##########", " ", "docs"), (0, "password: ", "xxxxxxxxxxxx", " ", ""),
    (0, "api_key: ", "x{16}", " ", ""), (0, "secret = ", "${|_|}", "\n", "ci.yaml"),
    (0, "card ", "#{16}", " and", ""), (0, "number ", "#{16}", " in", ""), (0, "the ", "#{19}", " of", ""), (0, "order ", "#{20}", " was", ""),
    (0, "phone ", "+##-###-#######-##", " or", ""), (0, "call ", "+#{15}", " ", ""), (0, "isbn ", "###-#-##-######-#-#", ",", ""),
    (0, "commit ", "~{40}", " fixed", "changes"), (0, "merge ", "~{40}", " into", "log"), (0, "revision ", "~{32}", " ", ""),
    (0, "md5 checksum ", "~{32}", " of", "readme"), (0, "sha256:", "~{64}", " ", "lock"), (0, "etag ", "~{32}", "-gzip", ""),
    (0, "see ", "~{40}", " for the", ""), (0, "blob ", "~{64}", " ", ""), (0, "integrity sha512-", "*{86}==", " ", "package-lock.json"),
    (0, "uuid ", "~{8}-~{4}-4~{3}-a~{3}-~{12}", " of", ""), (0, "", "~{8}-~{4}-4~{3}-b~{3}-~{12}", " is", "log"),
    (0, "at ", "2024-##-##T##-##-##", " by", ""), (0, "base64,", "*{300}", " ", "page.html"), (0, "image ", "iVBORw0KGgo*{120}", " ", ""),
    (0, "", "a{20}", " ", ""), (0, "and ", "-{40}", "\n", ""), (0, "", "_{30}", "\n", ""), (0, "url ", "/|/#{8}/|-|-|", " ", ""),
    (0, ". ", "T@{6}", " and", ""), (0, ". ", "E&{17}", " ", ""), (0, "of ", "&{18}", " ", ""), (0, "the ", "&{24}", ", ", ""),
    (0, "", "\u00a4{16}", "!! ", ""), (0, "A ", "\u00a4{22}", " ", ""), (0, "-", "&{16}", "-", ""), (0, "and ", "A@{3}-@{4}", ".", ""),
    (0, "the word ", "@{5}", " was", ""), (0, "www/", "|-|-|-#{6}", " ", ""), (0, "", "@{4}|@{4}", ", ", ""), (0, "id ", "|-|-#{10}", " ", ""),
)
FEATURES = ("n", "transitions", "common_pairs", "digits", "upper", "signs", "distinct_chars", "hexadecimal",
            "word", "dictionary", "key_prefix", "code_path", "named", "assigned", "harmless_before",
            "harmless_after", "quoted")


def candidates(docs: DataFrame) -> DataFrame:
    """One row for each candidate: place, text, and what stands around it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"), text.alias("text")
    ).filter(F.size("found") > 0)
    # The text between the candidates gives both neighbourhoods and the place.
    cut = found.select("doc_id", "text_key", "path", "found",
                       F.split("text", CANDIDATE, -1).alias("between"))
    around = cut.select(
        "doc_id", "text_key", "path", "found",
        F.transform("between", lambda x: F.struct(
            F.length(x).alias("n"), F.substring(x, 1, AROUND).alias("head"),
            F.right(x, F.lit(AROUND)).alias("tail"))).alias("between"))
    rows = around.select(
        "doc_id", "text_key", "path", "found", "between", F.posexplode("found").alias("k", "candidate"))
    before = (F.aggregate(F.slice("between", F.lit(1), F.col("k") + 1), F.lit(0),
                          lambda total, x: total + x["n"])
              + F.aggregate(F.slice("found", F.lit(1), F.col("k")), F.lit(0),
                            lambda total, x: total + F.length(x)))
    return rows.select(
        "doc_id", "text_key", "path", before.cast("bigint").alias("start"), "candidate",
        F.element_at("between", F.col("k") + 1)["tail"].alias("before"),
        F.element_at("between", F.col("k") + 2)["head"].alias("after"))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def _kinds(text: Column) -> Column:
    """The text with each character replaced by its class: lower, upper, digit, other."""
    for pattern, kind in (("[a-z]", "l"), ("[A-Z]", "u"), ("[0-9]", "d"), ("[^lud]", "o")):
        text = F.regexp_replace(text, pattern, kind)
    return text


def features(rows: DataFrame) -> DataFrame:
    c, n = F.col("candidate"), F.length("candidate").cast("double")
    lower = F.lower(c)
    # One character for a run of one class; a run less than that is a transition.
    runs = F.regexp_replace(_kinds(c), r"(.)\1+", "$1")
    known = F.length(F.regexp_replace(lower, "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    letters = F.length(F.regexp_replace(lower, "[^a-z]", "")).cast("double")
    common = F.regexp_count(lower, F.lit(f"(?=(?:{'|'.join(PAIRS)}))"))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(c, pattern, "")) / n

    return rows.select(
        "*", F.least(n, F.lit(128.0)).alias("n"),
        ((F.length(runs) - 1) / n).alias("transitions"),
        (common / F.greatest(letters - 1, F.lit(1.0))).alias("common_pairs"),
        share("[^0-9]").alias("digits"), share("[^A-Z]").alias("upper"), share("[A-Za-z0-9]").alias("signs"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.least(n, F.lit(64.0))).alias("distinct_chars"),
        _flag(c.rlike("^[0-9a-f]+$") | c.rlike("^[0-9A-F]+$")).alias("hexadecimal"),
        _flag(c.rlike("^[A-Z]?[a-z]+$") | c.rlike("^[A-Z]+$")).alias("word"),
        (1 - known / n).alias("dictionary"), _flag(c.rlike(KEY_PREFIX)).alias("key_prefix"),
        _flag(F.col("path").rlike(r"(?i)\.(py|js|ts|java|go|rb|php|sh|ya?ml|json|toml|ini|cfg|env)$|^\.?env$"))
        .alias("code_path"),
        _flag(F.col("before").rlike(NAMES)).alias("named"),
        _flag(F.col("before").rlike(f"(?:{ASSIGNED})$")).alias("assigned"),
        _flag(F.col("before").rlike(HARMLESS)).alias("harmless_before"),
        _flag(F.col("after").rlike(HARMLESS)).alias("harmless_after"),
        _flag(F.col("before").rlike("""["'(]$""") & F.col("after").rlike("""^["')]""")).alias("quoted"))


def _masks() -> list[tuple]:
    """SHAPES with ``x{n}`` written out."""
    return [(label, before, re.sub(r"(.)\{(\d+)\}", lambda m: m[1] * int(m[2]), value), after, path)
            for label, before, value, after, path in SHAPES]


def made_findings(spark: SparkSession, fillings: int = FILLINGS) -> DataFrame:
    """Labelled findings: (candidate, before, after, path, label), each shape filled many times."""
    shapes = spark.createDataFrame(
        [(k, float(label), *rest) for k, (label, *rest) in enumerate(_masks())],
        "shape int, label double, before string, mask string, after string, path string")
    rows = shapes.withColumn("filling", F.explode(F.sequence(F.lit(1), F.lit(fillings))))

    def filled(mark: Column, place: Column) -> Column:
        chosen = mark
        for k, units in UNITS.items():
            at = F.pmod(F.xxhash64(F.lit(SEED), "shape", "filling", place), F.lit(len(units))).cast("int")
            chosen = F.when(mark == k, F.element_at(F.array(*map(F.lit, units)), at + 1)).otherwise(chosen)
        return chosen

    return rows.select(
        F.array_join(F.transform(F.split("mask", ""), filled), "").alias("candidate"),
        "before", "after", "path", "label")


def labelled(rows: DataFrame, labels: DataFrame | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Features and label of the findings to train on; ``rows`` only say which session."""
    if labels is None:
        labels = made_findings(rows.sparkSession)
    given = (labels.select("candidate", "before", "after", "path", F.col("label").cast("double").alias("label"))
             .orderBy(F.xxhash64(F.lit(SEED), "candidate", "before", "after")).limit(max_labelled))
    return features(given).select(*FEATURES, "label")


def train(rows: DataFrame, labels: DataFrame | None = None,
          max_labelled: int = MAX_LABELLED) -> RandomForestClassificationModel:
    sample = materialize(
        VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        .transform(labelled(rows, labels, max_labelled)).select("features", "label"))
    return RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt",
        subsamplingRate=0.8, maxBins=32).fit(sample)


def findings(docs: DataFrame, labels: DataFrame | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row for each secret: document, place, length, digest."""
    # Few and narrow beside the texts: found once, judged from the shared folder.
    rows = materialize(features(candidates(docs)))
    model = train(rows, labels, max_labelled)
    judged = model.transform(
        VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
    return judged.filter("prediction = 1").select(
        "doc_id", "text_key", "start", F.length("candidate").cast("bigint").alias("n_chars"),
        F.sha2("candidate", 256).alias("secret_sha256"), "candidate")


def redact(docs: DataFrame, labels: DataFrame | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The documents with ``MARK`` in place of each secret; all rows and columns stay."""
    names = fresh(docs.columns, "found_id", "found_key", "places")
    # A document's places, at most as many as its text has room for.
    found = (findings(docs, labels, max_labelled).groupBy("doc_id", "text_key")
             .agg(F.sort_array(F.collect_set(F.struct("start", "n_chars"))).alias("places"))
             .toDF(*names))
    joined = join_rows(docs, found, "left")
    places = F.col(names[2])
    text = F.col("text")
    start = F.struct(F.lit("").alias("done"), F.lit(1).cast("bigint").alias("at"))
    cut = F.aggregate(
        places, start,
        lambda s, p: F.struct(
            F.concat(s["done"], F.substr(text, s["at"].cast("int"),
                                         (p["start"] + 1 - s["at"]).cast("int")), F.lit(MARK)
                     ).alias("done"),
            (p["start"] + p["n_chars"] + 1).alias("at")),
        lambda s: F.concat(s["done"], F.substr(text, s["at"].cast("int"))))
    clean = F.when(places.isNull(), text).otherwise(cut)
    n_chars = (F.length("text") + F.size(places) * len(MARK)
               - F.aggregate(places, F.lit(0).cast("bigint"), lambda n, p: n + p["n_chars"]))
    columns = [clean.alias(c) if c == "text" else
               F.when(places.isNull(), F.col(c)).otherwise(n_chars).cast(t).alias(c)
               if c == "n_chars" else F.col(c) for c, t in docs.dtypes]
    return joined.select(*columns)
