"""Secrets of many shapes: recall and precision on planted ones, candidates against a plain scan."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from eventlens.llm import secret_scan as S

MIXED = string.ascii_letters + string.digits
HEX = "0123456789abcdef"


def chars(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


#: Of the kind (text before, value, text behind); none is filled from the module's own shapes.
PLANTED = {
    "aws": lambda r: ("they used ", "AKIA" + chars(r, string.ascii_uppercase + "234567", 16), " in the job"),
    "slack": lambda r: ("and ", f"xoxb-{chars(r, string.digits, 12)}-{chars(r, string.digits, 12)}-{chars(r, MIXED, 24)}", " went out"),
    "github": lambda r: ("export GITHUB_PAT=", "ghp_" + chars(r, MIXED, 36), "\n"),
    "client": lambda r: ("client_secret_value = '", chars(r, MIXED, 30), "'"),
    "password": lambda r: ("password: ", chars(r, MIXED + "!#%&", 12) + "7", "\n"),
    "letters": lambda r: ("session_token = ", chars(r, string.ascii_letters, 32), " "),
    "long": lambda r: ("secret: ", chars(r, string.ascii_lowercase, 300) + chars(r, string.digits, 12), "\n"),
    "hex": lambda r: ('token = "', chars(r, HEX, 40), '"'),
    "bearer": lambda r: ("Authorization: Bearer ", chars(r, MIXED, 44), "\n"),
    "yaml": lambda r: ("apiKey: ", chars(r, MIXED, 20), "\n"),
    "stripe": lambda r: ("paid with ", "sk_live_" + chars(r, MIXED, 28), " today"),
}
HARMLESS = {
    "card": lambda r: ("card ", chars(r, string.digits, 16), " and"),
    "commit": lambda r: ("commit ", chars(r, HEX, 40), " fixed it"),
    "uuid": lambda r: ("uuid ", "-".join(chars(r, HEX, n) for n in (8, 4, 4, 4, 12)), " of"),
    "word": lambda r: ("the ", "donau" + "dampf" + "schiff" + "fahrts" + r.choice(["gesellschaft", "kapitaen"]), " was"),
    "name": lambda r: ("call ", "_".join(r.sample(["load", "user", "table", "index", "rows"], 4)), " first"),
    "code": lambda r: ("token = ", "_".join(r.sample(["get", "token", "from", "session"], 3)), "(request)"),
    "rule": lambda r: ("\n", "-" * r.randrange(20, 60), "\n"),
    "checksum": lambda r: ("md5 checksum ", chars(r, HEX, 32), " of"),
    "path": lambda r: ("see ", "/".join(r.sample(["server", "config", "local", "module", "view"], 4)), " for"),
    "prose": lambda r: ("The password: ", "everybody", " forgets it"),
}


def planted(docs, words, per_kind=12):
    rng, rows, truth = random.Random(12), [], {}
    for kinds, secret in ((PLANTED, True), (HARMLESS, False)):
        for kind, make in kinds.items():
            for _ in range(per_kind):
                w, (before, value, behind) = words(len(rows), 40), make(rng)
                at = rng.randrange(5, 35)
                rows.append((len(rows), " ".join(w[:at]) + " " + before + value + behind + " " + " ".join(w[at:])))
                truth[rows[-1][0]] = (kind, value, secret)
    return docs(*rows), truth


def test_planted_secrets_are_found_and_harmless_strings_stay(docs, words):
    frame, truth = planted(docs, words)
    found = {}
    for r in S.findings(frame).collect():
        found.setdefault(r.doc_id, []).append(r.candidate)
    for kind in PLANTED:
        own = [(i, v) for i, (k, v, s) in truth.items() if s and k == kind]
        assert sum(v in found.get(i, []) for i, v in own) >= 0.9 * len(own), kind
    right = sum(truth[i][2] and v == truth[i][1] for i, vs in found.items() for v in vs)
    assert right >= 0.9 * sum(map(len, found.values()))


def test_each_document_is_judged_alike_on_any_table(docs, words):
    frame, _ = planted(docs, words, per_kind=3)
    whole = {(r.doc_id, r.start) for r in S.findings(frame).collect()}
    part = {(r.doc_id, r.start) for r in S.findings(frame.filter("doc_id % 5 = 0")).collect()}
    assert part == {k for k in whole if k[0] % 5 == 0} and part


def plain_candidates(text):
    """The module's definition step by step: (start, candidate)."""
    out, at = [], 0
    behind_name = re.compile(rf"(?:{S.ASSIGNED})\Z")
    while at < len(text):
        value = re.compile(rf"{S.VALUE}{{{S.MIN_ASSIGNED},}}").match(text, at)
        if value and at and text[at - 1] in ":=> \n\t\"'(" and behind_name.search(text[max(0, at - 80):at]):
            end = value.end()
            while end > at and text[end - 1] in ".:":
                end -= 1
            if end - at >= S.MIN_ASSIGNED:
                out.append((at, text[at:end]))
                at = end
                continue
        run = re.compile(r"[A-Za-z0-9_+/-]{16,}").match(text, at)
        if run and not (at and re.match(r"[A-Za-z0-9_+/-]", text[at - 1])):
            end = run.end()
            end += len(re.compile("={0,2}").match(text, end)[0])
            out.append((at, text[at:end]))
            at = end
            continue
        at += 1
    return out


def test_candidates_equal_a_plain_scan(docs, words):
    frame, _ = planted(docs, words, per_kind=4)
    odd = docs((900, "a" * 40_000), (901, "password=" + "x" * 7 + " password=" + "y" * 8 + ". end"),
               (902, "token: abc.def.ghi: token => (value12345) " * 3), (903, "ABCDEFGHIJKLMNOP== é" * 4), (904, None))
    rows = frame.union(odd)
    texts = {r.doc_id: r.text for r in rows.collect()}
    got = sorted((r.doc_id, r.start, r.candidate) for r in S.candidates(rows).collect())
    assert got == sorted((i, *c) for i, t in texts.items() for c in plain_candidates(t or ""))


def test_forest_tells_shapes_it_was_not_trained_on(spark):
    made = S.made_findings(spark, 20)
    rows = S.features(made.withColumn("doc_id", F.lit(1)))
    held = F.pmod(F.xxhash64("before", "after"), F.lit(5)) == 0  # whole shapes
    model = S.train(rows, made.filter(~held))
    from pyspark.ml.feature import VectorAssembler
    judged = model.transform(VectorAssembler(inputCols=list(S.FEATURES), outputCol="features").transform(rows.filter(held)))
    right = judged.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert right >= 0.85


def test_callers_may_give_their_own_findings(spark, docs, words):
    frame, truth = planted(docs, words, per_kind=3)
    own = S.made_findings(spark, 5).withColumn("label", F.lit(0.0)).union(
        S.made_findings(spark, 5).filter("after = 'nothing'"))
    assert S.findings(frame, labels=own, max_labelled=100).count() == 0


@pytest.mark.parametrize("label", [0, 1])
def test_shapes_are_candidates_or_short(spark, label):
    """A shape that the scan would never offer teaches nothing."""
    rows = [r for r in S.made_findings(spark, 1).filter(F.col("label") == label).collect()]
    short = [r.candidate for r in rows if not any(
        c == r.candidate for _, c in plain_candidates(f"x {r.before}{r.candidate}{r.after}"))]
    assert len(short) <= 0.3 * len(rows), short
