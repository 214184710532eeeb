"""Fill-in-the-middle, SimHash and the repair of conversations, against plain versions."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventlens.llm import conversation_repair as C
from eventlens.llm import fill_middle as M
from eventlens.llm import simhash_dedup as S


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11: fill in the middle ------------------------------------------------------------

def plainly(doc_id, text):
    """(form, prefix, middle, output) in one go."""
    text = text or ""
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or h3 % 100 >= 90 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return "plain", None, None, text
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def expected_cuts(rows):
    out = []
    for doc_id, text in rows:
        form, p, m, output = plainly(doc_id, text)
        out.append((doc_id, len(text or ""), form, p, m, sha(output), sha(text or "")))
    return out


@pytest.mark.parametrize("chunk", [M.CHUNK, 5])
def test_outputs_and_restored_texts_equal_plain_ones(docs, chunk):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab<>PSM é𝄞\n") for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(None, "no id at all"), (None, "no id at all"), (None, None), (400, ""), (401, "a <P> in it"),
             (402, "x" * 70_000), (403, "<"), (404, "<P"), (404, "<P")]
    got = M.digests(docs(*rows), chunk=chunk).collect()
    assert ordered(got) == ordered(expected_cuts(rows))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_pieces_give_the_texts(docs):
    rows = [(i, f"text number {i} " * (i + 1)) for i in range(40)]
    pieces = M.transform(docs(*rows), chunk=50)
    assert max(len(r.text) for r in pieces.collect()) <= 53
    assert ordered((r.doc_id, r.form, r.text) for r in M.texts(pieces).collect()) == ordered(
        (i, plainly(i, t)[0], plainly(i, t)[3]) for i, t in rows)


def test_marks_across_pieces_are_found():
    output = "<P>a<b<S><<PS>c<M>d<"
    for size in range(1, 8):
        split = M.Splitter("psm")
        found = [x for k in range(0, len(output), size) for x in split.feed(output[k:k + size])] + split.end()
        assert ["".join(t for p, t in found if p == part) for part in range(3)] == ["a<b", "d<", "<<PS>c"]


def test_texts_are_shuffled_once(docs):
    plan = M.digests(docs((1, "abc")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_odd_documents_and_an_empty_table(docs, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert ordered(M.digests(odd_docs).collect()) == ordered(expected_cuts(rows))
    assert M.digests(docs().limit(0)).collect() == []


# ---- 12: SimHash -----------------------------------------------------------------------

def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, threshold):
    """The smallest reachable index of each."""
    top = list(range(len(prints)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= threshold:
            a, b = sorted((root(i), root(j)))
            top[b] = a
    return [root(x) for x in range(len(prints))]


def plain_clusters(rows):
    prints = [plain_print(t) for _, t in rows]
    least = {}
    tops = plain_components(prints, 4)
    for (i, _), t in zip(rows, tops, strict=True):
        least[t] = min((x for x in (i, least.get(t)) if x is not None), default=None)
    return [(i, f"{p:016x}", least[t]) for (i, _), p, t in zip(rows, prints, tops, strict=True)]


@pytest.mark.parametrize("cover", S.COVERS)
def test_clusters_equal_brute_force(docs, words, cover):
    rows = []
    for g in range(5):
        base = words(g, 150 + 90 * g)
        for c in range(16):
            rng, w = random.Random(100 * g + c), list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                w[rng.randrange(len(w))] = "other"
            rows.append((len(rows), " ".join(w)))
    rows += [(900, "One two"), (901, "one TWO"), (902, None), (903, " \n"), (None, "a b c d e"), (None, None)]
    assert ordered(S.cluster(docs(*rows), cover=cover).collect()) == ordered(plain_clusters(rows))
    assert len({r[2] for r in plain_clusters(rows)}) < len(rows) - 20


@pytest.mark.parametrize("cover", S.COVERS)
@pytest.mark.parametrize("chunk", [S.CHUNK, 16])
def test_no_link_is_lost_at_any_distance(spark, cover, chunk):
    """Chains of fingerprints at 1 to 6 bits, crowds around a centre among them."""
    rng = np.random.default_rng(7)
    prints = {0, 1, 2**64 - 1}
    for _ in range(60):
        at = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(int(rng.choice([2, 3, 40]))):
            prints.add(at)
            for place in rng.choice(64, rng.integers(1, 7), replace=False):
                at ^= 1 << int(place)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print bigint")
    found = [(r.a % 2**64, r.b % 2**64) for r in S.links(frame, cover, chunk=chunk).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    index = {p: k for k, p in enumerate(prints)}
    top = list(range(len(prints)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in found:
        a, b = sorted((root(index[a]), root(index[b])))
        top[b] = a
    assert [root(x) for x in range(len(prints))] == plain_components(prints, 4)


def test_a_crowd_gives_a_forest_not_all_pairs(spark):
    rng = np.random.default_rng(8)
    centre = int(rng.integers(0, 2**63))
    crowd = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (1500, 2))}
    frame = spark.createDataFrame([(p,) for p in crowd], "print bigint")
    n = S.links(frame, S.COVERS[0]).count()
    # All pairs of the crowd are linked.
    assert len(crowd) - 1 <= n < 40 * len(crowd)


@pytest.mark.parametrize("block", [S.Block(0, 9, 3, 1), S.Block(0, 8, 2, 2), S.Block(0, 6, 0, 0)])
def test_each_near_pair_meets_at_the_homes(block):
    all_words = np.arange(1 << block.bits, dtype=np.uint64)
    syndromes, changes = block.syndromes(all_words), block.patterns()
    home = [int(w ^ changes[s][0]) for w, s in zip(all_words, syndromes, strict=True)]
    reach = [set((w ^ changes[s]).tolist()) for w, s in zip(all_words, syndromes, strict=True)]
    anchors = set(home)
    assert all(a in anchors for r in reach for a in r)
    for x, y in itertools.product(range(len(home)), repeat=2):
        if (x ^ y).bit_count() <= block.threshold:
            assert home[x] in reach[y]


def test_covers_are_checked(spark):
    assert all(S.covers(c, 4) for c in S.COVERS)
    assert S.cheapest(10**6) == S.COVERS[0] and S.cheapest(10**12) == S.COVERS[1]
    with pytest.raises(ValueError):
        S.links(spark.createDataFrame([], "print bigint"), S.COVERS[0], threshold=5)


def test_odd_documents_are_fingerprinted(docs, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert ordered(S.cluster(odd_docs).collect()) == ordered(plain_clusters(rows))
    assert S.cluster(docs().limit(0)).collect() == []


# ---- 13: conversations -----------------------------------------------------------------

def legal(roles):
    text = "".join(r[:1] or "?" for r in roles)
    pairs = text[1:] if text.startswith("s") else text
    return not text or (len(pairs) > 0 and pairs == "ua" * (len(pairs) // 2))


def cheapest_by_trial(rows):
    """(cost, audit, kept) of all ways to edit rows of (role, text, fault)."""
    best = None
    fits = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    options = []
    for role, text, fault in rows:
        cut = 3 if fault == "truncated" else 0
        own = [("D", 4, [])]
        if fault not in ("blank", "duplicate"):
            own += [("K", cut, [(role, text)])] + [("R", 3 + cut, [(r, text)]) for r in ("user", "assistant")]
        options.append([("I" * len(f) + e, 3 * len(f) + c, [(r, "") for r in f] + k)
                        for f in fits for e, c, k in own])
    options.append([("I" * len(f), 3 * len(f), [(r, "") for r in f]) for f in fits])
    for way in itertools.product(*options):
        kept = [x for _, _, k in way for x in k]
        key = (sum(c for _, c, _ in way), "".join(e for e, _, _ in way))
        if (best is None or key < best[:2]) and legal([r for r, _ in kept]):
            best = (*key, kept)
    return best


def by_fault(rows):
    """(turn, role, text, fault) of sorted rows."""
    seen, out = set(), []
    for turn, role, text in rows:
        body = text.rstrip(" \t\n\v\f\r")
        fault = ("blank" if not body else "duplicate" if (role, text) in seen
                 else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def expected_summary(rows):
    """Of (conv_id, turn, role, text) rows."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, own in groups.items():
        own = by_fault(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])))
        turns = {t for t, *_ in own if t is not None}
        faults = [f for *_, f in own]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(own)]
        cost, audit, kept = cheapest_by_trial([r[1:] for r in own])
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    sha("\n".join(f"{r}:{t}" for r, t in kept))))
    return out


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_repairs_equal_all_trials(spark):
    rng = random.Random(3)
    roles, said = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No!", "cut", " ", "", None, "Yes."]
    rows = [(c if c else None, rng.choice([None, 0, 1, 1, 2, 3, 7]), rng.choice(roles), rng.choice(said))
            for c in range(200) for _ in range(rng.randrange(1, 4))]
    got = C.summary(C.repair(spark.createDataFrame(rows, TURNS))).collect()
    assert ordered(got) == ordered(expected_summary(rows))


def test_ties_are_settled_over_whole_unresolved_edits():
    """Against a search that keeps every survivor's whole edits."""
    rng = random.Random(5)
    for _ in range(200):
        rows = [C.Row(k, rng.choice(["user", "assistant", "system", "x"]), "t",
                      rng.choice([None, None, "truncated", "blank"])) for k in range(rng.randrange(40))]
        whole = {C.START: (0, "")}
        for row in rows:
            cut, best = 3 if row.fault == "truncated" else 0, {}
            for state, (cost, audit) in whole.items():
                for put, at in C.INSERTS[state]:
                    c, a = cost + 3 * len(put), audit + "I" * len(put)
                    ways = [(at, c + 4, a + "D")]
                    if row.fault != "blank":
                        ways += [(to, c + cut + (0 if row.role[0] == i else 99), a + "K")
                                 for i, to in C.NEXT[at].items()]
                        ways += [(to, c + cut + 3, a + "R") for i, to in C.NEXT[at].items() if i != "s"]
                    for to, *key in ways:
                        best[to] = min(best.get(to, (10**9, "")), tuple(key))
            whole = best
        cost, audit = min((c + 3 * len(put), a + "I" * len(put)) for s, (c, a) in whole.items()
                          for put, at in C.INSERTS[s] if at in C.FINAL)
        search = C.Search()
        edits = [e for row in rows for e in search.add(row)] + search.finish()
        assert (sum(e.cost for e in edits), "".join(e.letter for e in edits)) == (cost, audit)


def test_memory_of_a_long_conversation_is_bounded():
    search, rng, held, out = C.Search(), random.Random(6), [], 0
    for k in range(20_000):
        role = rng.choice(["user", "assistant", "assistant", "system"])
        out += len(search.add(C.Row(k, role, "t", rng.choice([None, "truncated", "duplicate"]))))
        held.append(search.held())
        assert held[-1] < 100
    assert out > 19_900
    assert out + len(search.finish()) >= 20_000


def test_a_conversation_over_many_batches_is_one(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Line {k}.") for k in range(25_000)]
    edits = C.repair(spark.createDataFrame(rows, TURNS))
    (row,) = C.summary(edits).collect()
    assert (row.cost, row.audit) == (0, "K" * 25_000)
    assert row.repaired_sha256 == sha("\n".join(f"{r}:{t}" for _, _, r, t in rows))
    again = edits.repartition(3, "conv_id").sortWithinPartitions("conv_id", "place")
    assert C.summary(again).collect() == [row]


def test_damage_follows_the_checksum(spark):
    import zlib
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(12) for t in range(12)]
    expected = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        new = (c, t, "user" if kind == 4 else role,
               "" if kind == 1 else "One Two Three" if kind == 2 else text)
        expected += [] if kind == 0 else [new, new] if kind == 3 else [new]
    assert ordered(C.damaged(spark.createDataFrame(rows, TURNS)).collect()) == ordered(expected)
    assert len(expected) != len(rows)


def test_conversations_without_rows_left_and_empty_tables(spark):
    import zlib
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 1, "user", "Hello.")], TURNS)
    (row,) = C.repair_damaged(frame.withColumns({n: F.lit("clash") for n in ("kind", "copy", "key", "id", "place")})).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", sha(""))
    assert C.repair_damaged(frame.limit(0)).collect() == []
    assert C.repair(frame.limit(0)).collect() == []


# ---- the SQL of the quality rules ------------------------------------------------------

def test_rules_and_their_sql_agree_where_documents_share_their_smallest_line(spark, docs, words, tmp_path):
    """Boilerplate in most documents; counting documents by one line of theirs would miss it."""
    duckdb = pytest.importorskip("duckdb")
    from eventlens.llm import queries as Q
    boiler = [" ".join(words(500 + k, 12)) for k in range(6)]
    rows = []
    for i in range(60):
        own = [" ".join(words(i * 7 + k, 9)) for k in range(3 if i % 2 else 1)]
        rows.append((i, "\n".join(own + boiler[:1 + i % 6]), "one host"))
    rows += [(100 + k, rows[0][1], "one host") for k in range(30)] + [(200, "", "one host"), (201, None, "two")]
    frame = docs(*rows)
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    found = Q.QUERIES["op10_quality_rules"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = con.execute(Q.ORACLES["op10_quality_rules"])
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert ordered(found.select(*names).collect()) == ordered(expected)
    assert len({(r[names.index("kept")], r[names.index("n_removed_words")] > 0) for r in expected}) >= 3


# ---- BPE in windows --------------------------------------------------------------------

@pytest.mark.parametrize("window", [1, 7, 60])
def test_windows_change_no_token(monkeypatch, window):
    public = pytest.importorskip("public_tokenizers")
    library = pytest.importorskip("tokenizers")
    from eventlens.llm import bpe
    path = public.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        ours = bpe.Tokenizer(bpe.Merges.from_json(file.read()))
    theirs = library.Tokenizer.from_file(path)
    monkeypatch.setattr(bpe, "WINDOW", window)
    rng = random.Random(window)
    for _ in range(150):
        text = "".join(rng.choice("ab c'  \n\té漢1.<|>x") for _ in range(rng.choice([5, 80, 900])))
        text += rng.choice(["", " <|endoftext|> ", "=" * 400, "don't  stop"])
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        assert ours.round_trip(text) == (len(ids), sha(",".join(map(str, ids))), sha(decoded))


def test_remembered_pieces_stay_few_megabytes():
    import tracemalloc

    from eventlens.llm import bpe
    from eventlens.llm import queries as Q
    with open(Q.tokenizer_path(), encoding="utf-8") as file:
        ours = bpe.Tokenizer(bpe.Merges.from_json(file.read()))
    texts = [" ".join(f"w{k}x" for k in range(low, low + 1000)) for low in range(0, 250_000, 1000)]
    tracemalloc.start()
    for text in texts:
        ours.round_trip(text)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 48 << 20


def test_common_pieces_outlast_rare_ones(monkeypatch):
    from eventlens.llm import bpe
    from eventlens.llm import queries as Q
    with open(Q.tokenizer_path(), encoding="utf-8") as file:
        ours = bpe.Tokenizer(bpe.Merges.from_json(file.read()))
    monkeypatch.setattr(bpe, "CACHED_PIECES", 50)
    merged, merge = [], ours.merges.merge
    monkeypatch.setattr(ours.merges, "merge", lambda data: merged.append(data) or merge(data))
    for k in range(400):
        ours.round_trip(f" common r{k}")
        assert len(ours.pieces) + len(ours.pieces.older) <= 100
    assert merged.count(b" common") == 1


# ---- shards ----------------------------------------------------------------------------

def test_rows_of_one_key_are_dealt_to_many_cells(docs):
    from eventlens.llm import sharding
    rows = docs(*[(None, f"text {k}", "one") for k in range(600)])
    hashes = rows.select(sharding.shuffle_key(1, F.col("doc_id"), F.col("text")).alias("h"))
    assert hashes.select(F.shiftright("h", 46)).distinct().count() > 50
    got = sharding.assign(rows, "doc_id", "source", 7).collect()
    sizes = [sum(r.shard == s for r in got) for s in range(7)]
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(7) for k in range(sizes[s])]
    assert sum(sizes) == 600 and max(sizes) - min(sizes) <= 1
    assert sharding.cells_for(10) == 4096 and sharding.cells_for(10**9) == 32768
