import collections
import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm import paragraphs, queries, simhash, suffixes
from recordloom.llm.components import connected_components, forest
from recordloom.llm.scratch import Scratch

rng = np.random.default_rng(5)


def words(n, kinds=40):
    return " ".join(f"w{k}" for k in rng.integers(0, kinds, n))


def test_components(spark):
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(900 + i, 901 + i) for i in range(40)] + [(5000, 6000 + i) for i in range(500)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {r["node"]: r["root"] for r in connected_components(df, Scratch(spark, "t")).collect()}
    names = sorted({x for e in edges for x in e if e[0] != e[1]})
    at = {x: i for i, x in enumerate(names)}
    real = [e for e in edges if e[0] != e[1]]
    root = forest(len(names), np.array([at[a] for a, _ in real]), np.array([at[b] for _, b in real]))
    assert got == {x: names[root[at[x]]] for x in names}
    assert connected_components(df.limit(0), Scratch(spark, "t")).count() == 0


def brute_fingerprint(text):
    w = text.encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_is_brute_force(spark):
    base = [words(30) for _ in range(30)]
    texts = [None, "", " \n", "A", "a", "ß É"]
    for t in base:
        texts += [t, t.upper(), t + " x", " ".join(t.split()[1:])]
    texts += ["a b"] * 30 + [base[0] + words(600), words(300)]
    rows = [(i, t, "extra", 7) for i, t in enumerate(texts)] + [(3, "A", "again", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, node int").repartition(3)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    fps = {i: brute_fingerprint(t or "") for i, t, *_ in rows}
    assert all(int.from_bytes(r["fp"], "little") == fps[r["id"]] for r in got)
    ids = sorted(fps)
    x = np.array([fps[i] for i in ids], np.uint64)
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    root = forest(len(ids), a, b)
    assert {r["id"]: r["component_id"] for r in got} == {i: ids[root[k]] for k, i in enumerate(ids)}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_balls_are_complete():
    keys = []
    for b in rng.integers(0, 2**63, 60, dtype=np.uint64):
        keys.append(int(b))
        for d in (1, 2, 3, 4):
            x = int(b)
            for bit in rng.choice(64, d, replace=False):
                x ^= 1 << int(bit)
            keys.append(x)
    keys = np.unique(np.array(keys, np.uint64))
    apart = np.bitwise_count(keys[:, None] ^ keys[None, :])
    want = forest(len(keys), *np.nonzero(apart <= 3))
    a, b = [], []
    for prefix in (0, 3):
        a, b = [], []
        for cell in range(1 << prefix):
            index, to = simhash.destinations(keys, 64, prefix) if prefix else (np.arange(len(keys)), np.zeros(len(keys), int))
            mine = index[to == cell]
            group, member = simhash.meetings(keys[mine], 64, prefix, cell)
            u, v = simhash.links(keys[mine][:, None], group, member, 3)
            a, b = np.append(a, mine[u]), np.append(b, mine[v])
        assert (forest(len(keys), a.astype(int), b.astype(int)) == want).all()


def test_keep_one(spark):
    t = [words(400, 5000) for _ in range(6)]
    near = " ".join(["x", *t[0].split()[1:-1], "y"])
    rows = [(1, near, "k"), (2, t[0], "k"), (2, t[0], "k"), (3, t[1], "k"), (4, t[1], "k"), (5, t[2], "k"), (None, t[3], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _x string")
    got = simhash.keep_one(df, shingle=5, words=5, width=32, radius=52)
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 3, 5]


def brute_repeats(texts, n):
    seen = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = True
        out.append(bytes(np.frombuffer(t, np.uint8)[~gone]))
    return out


def test_two_stage_sort():
    for _ in range(40):
        t = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 300))).astype(np.uint8)
        assert suffixes.two_stage(t, 2000).tolist() == sorted(range(len(t)), key=lambda i: t.tobytes()[i:])


@pytest.mark.parametrize("hot", [600_000, 3000])
def test_suffixes_are_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    letters = list("abcdeé ")
    make = lambda n: "".join(rng.choice(letters, n))
    base, texts = [make(200) for _ in range(8)], ["", None, "x" * 3000, "y" * 39, "y" * 40, "ab" * 60]
    for i in range(120):
        b = base[rng.integers(0, 8)]
        texts.append([b, make(40) + b[20:120] + make(30), make(int(rng.integers(0, 80))), b[:90] + "#" + b[90:], make(60) + base[0][100:160] + make(60)][i % 5])
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(0, "", 1), (7, texts[7], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int").repartition(4)
    want = brute_repeats([(t or "").encode() for _, t, _ in rows], 40)
    got = suffixes.remove_repeats(df, 40, 16).collect()
    assert sorted((r["doc_id"], bytes(r["kept"])) for r in got) == sorted((i, w) for (i, *_), w in zip(rows, want))
    assert all(r["n_bytes"] - sum(s["length"] for s in r["removed"]) == len(r["kept"]) for r in got)
    assert suffixes.remove_repeats(df.limit(0), 40).count() == 0


def brute_cuts(text):
    """(kind, start, words) of each line and passage, by plain loops."""
    out, at = [], 0
    for line in text.split("\n"):
        w = re.findall(r"[^ \t-\r]+", line)
        if len(w) >= 5:
            out.append((0, at, len(w)))
        at += len(w)
    x = [int(h) for h in paragraphs.hashed_words(np.frombuffer(text.encode(), np.uint8))[0]]
    assert len(x) == at
    key = []
    for i, h in enumerate(x):
        after = x[i + 1] * 0x9E3779B97F4A7C15 % 2**64 if i + 1 < at else 0
        k = (h ^ after) * 0xD6E8FEB86659FD93 % 2**64
        key.append(k ^ k >> 31)
    near = paragraphs.NEAR
    least = [i for i in range(at) if all(key[i] < k for k in key[max(0, i - near) : i]) and all(key[i] <= k for k in key[i + 1 : i + near + 1])]
    edges = sorted({0, at, *least})
    edges = sorted({*edges, *(k for a, b in zip(edges, edges[1:]) for k in range(a, b, paragraphs.LONG))})
    for s in edges[:-1]:
        e = min([k for k in edges if k >= s + paragraphs.LEAST] or [at])
        if e - s >= paragraphs.LEAST or (s == 0 and e >= 5):
            out.append((1, s, e - s))
    return out


def brute_classes(rows):
    """Counter of (id, kind, start, words, keeper id, keeper start) over all paragraphs that have a near duplicate."""
    at, sets = [], []
    for i, t, *_ in rows:
        w = [x.decode() for x in (t or "").encode().lower().split()]
        for kind, s, n in brute_cuts(t or ""):
            at.append((i, kind, s, n))
            sets.append(([tuple(w[j : j + 5]) for j in range(s, s + n - 4)], kind))
    a, b = [], []
    index = collections.defaultdict(set)
    for i, (x, kind) in enumerate(sets):
        for g in x:
            index[g, kind].add(i)
    for i, (x, kind) in enumerate(sets):
        for j in set().union(*(index[g, kind] for g in x)):
            y = sets[j][0]
            if j > i and len({*x} & {*y}) >= 0.8 * len({*x} | {*y}) and (not kind or x[0] == y[0]):
                a.append(i)
                b.append(j)
    order = sorted(range(len(at)), key=lambda k: (at[k][0], at[k][2]))
    place = {k: n for n, k in enumerate(order)}
    root = forest(len(at), np.array([place[k] for k in a], int), np.array([place[k] for k in b], int))
    size = collections.Counter(root.tolist())
    return collections.Counter((*at[order[n]], at[order[r]][0], at[order[r]][2]) for n, r in enumerate(root.tolist()) if size[r] > 1)


def paragraph_rows():
    base = [words(60, 3000) for _ in range(20)]
    rows = []
    for i in range(60):
        p = base[i % 20].split()
        if i % 3 == 1:
            p[int(rng.integers(0, 60))] = "changed"
        elif i % 3 == 2:
            p[20:40] = words(20, 3000).split()
        rows.append((i, "\n".join(["short line", " ".join(p), words(30, 3000)]), 9, "z"))
    for i in range(30):  # inside longer lines, and across line breaks
        p = base[i % 20].split()
        rows.append((100 + i, words(25, 3000) + " " + (" ".join(p) if i % 2 else " ".join(p[:30]) + "\n" + " ".join(p[30:])) + " " + words(25, 3000), 9, "z"))
    return rows + [(60, None, 0, "z"), (61, "", 0, "z"), (62, base[3], 1, "z"), (62, base[3], 1, "z"), (63, "same " * 400, 1, "z"), (64, " \n\t\n", 1, "z"), (65, "É\u00a0é A\tb\r\nC d e f g h", 1, "z")]


def found_classes(found):
    return collections.Counter((r["id"], r["kind"], r["start"], r["n_words"], r["keeper"]["id"], r["keeper"]["start"]) for r in found)


def test_paragraphs_are_brute_force(spark):
    rows = paragraph_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, node string").repartition(3)
    found = paragraphs.near_duplicate_paragraphs(df).collect()
    want = brute_classes(rows)
    assert found_classes(found) == want
    assert len({r["class_id"] for r in found}) == len({(k[1], *k[4:]) for k in want})
    assert all(r["kept"] == (r["id"] == r["keeper"]["id"] and r["start"] == r["keeper"]["start"]) for r in found)
    assert paragraphs.near_duplicate_paragraphs(df.limit(0)).count() == 0


def test_op2_is_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = queries.op2_substring_dedup(spark, "/root/testdata/sf0.001").collect()
    want = brute_classes(rows)
    have = collections.Counter((r["doc_id"], r["kind"], r["start"], r["n_words"], r["keeper_doc_id"], r["keeper_start"]) for r in got)
    assert sum((have & want).values()) >= 0.99 * max(sum(have.values()), sum(want.values()))  # banding misses 3 in 1000 links at 0.8


def test_repeated_passages_are_found(spark):
    """Recall on planted passages of 51 to 120 words, within lines and across line breaks, each in two documents."""
    rows, planted = [], 150
    for i in range(planted):
        p = words(int(rng.integers(51, 121)), 5000).split()
        for k in range(2):
            q = [x + ("\n" if j % 23 == 9 * k + 9 and i % 2 else " ") for j, x in enumerate(p)]
            rows.append((2 * i + k, words(int(rng.integers(5, 90)), 5000) + " " + "".join(q) + words(int(rng.integers(5, 90)), 5000)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["id"] for r in paragraphs.near_duplicate_paragraphs(df).collect()}
    assert len({i // 2 for i in found}) >= 0.95 * planted
    fresh = [(i, words(int(rng.integers(5, 300)), 5000)) for i in range(200)]
    assert paragraphs.near_duplicate_paragraphs(spark.createDataFrame(fresh, "doc_id long, text string")).count() == 0


def test_null_ids_and_very_long_texts(spark):
    long = words(700_000, 100_000)
    part = " ".join(long.split()[300_000:300_200])
    rows = [(None, part), (1, long), (None, None), (2, "a b c d e f"), (None, "a b c d e f")]
    found = paragraphs.near_duplicate_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["id"], r["kept"]) for r in found} == {(1, True), (2, True), (None, False)}
    left = paragraphs.drop_repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["text"] for r in left if r["doc_id"] == 1] == [long] and sum(r["doc_id"] is None for r in left) == 2


@pytest.mark.parametrize("part", [400, 7])
def test_no_link_between_unlike_centres_is_lost(spark, monkeypatch, part):
    monkeypatch.setattr(paragraphs, "PART", part)
    base, rows = [f"w{i}" for i in range(88)], []
    for i, k in enumerate(rng.choice([10, 12, 14, 30, 32, 50, 53, 56, 70, 72], 80)):  # only changes near each other leave 0.8
        rows.append((i, " ".join(base[:k] + [f"c{i}"] + base[k + 1 :])))
    found = paragraphs.near_duplicate_paragraphs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("kind = 0").collect()
    want = collections.Counter({k: n for k, n in brute_classes(rows).items() if k[1] == 0})
    assert found_classes(found) == want and len({k[4] for k in want}) > 1


def test_small_batches_and_groups_make_no_more_rows(spark, monkeypatch):
    rows = [(i, f"{words(60, 5000)}\n{words(40, 5000)}" if i % 4 else "one line that very many of the texts hold") for i in range(600)]
    df, real, seen = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), type(spark.range(1)).repartition, []
    monkeypatch.setattr(type(df), "repartition", lambda self, *how: (seen.append(self), real(self, *how))[1])
    before = spark.conf.get(corpus_pipeline.ROWS)
    try:
        spark.conf.set(corpus_pipeline.ROWS, 10)
        paragraphs.candidate_links(df, "text", 5, 5)
        assert 0 < seen[0].count() <= 3 * (4 * 4 + 1)  # a row for each task of the next step, and one of links, from each partition
        spark.conf.unset(corpus_pipeline.ROWS)
        links = [{tuple(r) for r in paragraphs.candidate_links(df, "text", 5, 5).collect()}]
        monkeypatch.setattr(paragraphs, "HELD", 100)
        links.append({tuple(r) for r in paragraphs.candidate_links(df, "text", 5, 5).collect()})
        assert links[0] and links[0] == links[1]
    finally:
        spark.conf.set(corpus_pipeline.ROWS, before)


def test_bands_are_dealt_in_turns(spark, monkeypatch):
    own, n = np.random.default_rng(8), 900  # a generator of its own: the other tests' words stay as they are
    fp = own.integers(0, 1 << 64, (n, 4), dtype=np.uint64)
    fp[600:] = fp[:300] ^ (np.uint64(1) << own.integers(0, 64, (300, 4), dtype=np.uint64))
    df = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(fp)], "node long, fp binary").repartition(3)
    whole = {tuple(r) for r in simhash.linked_fingerprints(df, Scratch(spark, "t"), 4, 32, 40, 2).collect()}
    assert {(i + 600, i) for i in range(300)} <= whole
    real, seen = type(df).repartition, []
    monkeypatch.setattr(type(df), "repartition", lambda self, *how: (seen.append(self), real(self, *how))[1])
    monkeypatch.setattr(simhash, "CELL_WORDS", 1000)  # as many cells as for very many fingerprints
    assert {tuple(r) for r in simhash.linked_fingerprints(df, Scratch(spark, "t"), 4, 32, 40, 2).collect()} == whole
    at_once = [x.agg(F.sum(F.length("rows"))).first()[0] for x in seen]
    assert sum(at_once) > 2500 * n and max(at_once) <= 1.1 * 2500 * n


def test_paragraphs_leave_one(spark):
    p = words(60, 3000)
    rows = [(1, f"alpha\n{p}", 0), (2, p, 0), (3, f"{p}\nbeta", 0), (4, "", 0), (5, None, 0), (6, words(50, 3000), 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in paragraphs.drop_repeated_paragraphs(df).collect()}
    assert got == {1: (rows[0][1], 0), 3: ("beta", 4), 4: ("", 0), 5: (None, 0), 6: (rows[5][1], 0)}


def test_words_are_cut_out():
    t = " a b\nc d \u00a0e\tf\n\ng "
    assert paragraphs.without(t, []) == t
    assert paragraphs.without(t, [(1, 1)]) == " a\nc d \u00a0e\tf\n\ng "
    assert paragraphs.without(t, [(2, 2)]) == " a b\n\u00a0e\tf\n\ng "
    assert paragraphs.without(t, [(0, 2)]) == "c d \u00a0e\tf\n\ng "
    assert paragraphs.without(t, [(4, 1), (5, 2)]) == " a b\nc d"
    assert paragraphs.without(t, [(3, 1), (3, 2)]) == " a b\nc f\n\ng "
    assert paragraphs.without(t, [(0, 7)]) == ""


def test_lines_down_to_one_shingle_are_paragraphs(spark):
    nine, twelve = [f"n{i}" for i in range(9)], [f"t{i}" for i in range(19)]
    lines = [" ".join(nine), "five words and no more", " ".join(twelve), "only four words here"]
    rows = [(1, "\n".join(lines)), (2, "\n".join([lines[0].upper(), lines[1], " ".join(twelve[1:]), lines[3]])), (3, "alpha " + lines[0])]
    found = paragraphs.near_duplicate_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).where("kind = 0").collect()
    assert {(r["id"], r["start"]): (r["keeper"]["id"], r["keeper"]["start"]) for r in found} == {(i, k): (1, k) for k in (0, 9, 14) for i in (1, 2)} | {(3, 0): (1, 0)}


def test_op7_is_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    odd = [(10**6 + i, t) for i, t in enumerate([None, "", " \n", "A", "ß É", "a\u00a0b c d", "x " * 3000])]
    spark.createDataFrame(odd, "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    for folder, docs in ((sf, rows), (f"file://{tmp_path}", odd)):
        got = queries.op7_simhash(spark, folder).collect()
        want = {i: brute_fingerprint(t or "") for i, t in docs}
        assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{x:016x}" for i, x in want.items()} and len(got) == len(docs)
        ids = sorted(want)
        x = np.array([want[i] for i in ids], np.uint64)
        root = forest(len(ids), *np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3))
        assert {r["doc_id"]: r["component_id"] for r in got} == {i: ids[root[k]] for k, i in enumerate(ids)}


def test_op3_is_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    kept = brute_repeats([t for _, t in rows], 200)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in queries.op3_suffix_array_dedup(spark, sf).collect()}
    assert got == {i: (len(t), len(t) - len(k), hashlib.sha256(k).hexdigest()) for (i, t), k in zip(rows, kept)}


def test_documents_are_linked_by_exact_jaccard(spark):
    own = np.random.default_rng(11)
    rows, sets = [], []
    for i in range(160):
        n = int(own.integers(80, 200))
        w = [f"v{k}" for k in own.integers(0, 10**6, n)]
        cut = round((n - 4) * (1 - [0.76, 0.81][i % 2]))
        line = " ".join(f"r{i}x{k}" for k in range(16))
        a, b = " ".join(w), " ".join(w[cut:] if i % 4 < 2 else w[: n - cut])
        if i >= 120:  # unrelated texts with one line that both repeat
            a, b = (" ".join([f"q{k}" for k in own.integers(0, 10**6, 154)] + [line] * 40) for _ in range(2))
        rows += [(2 * i, a), (2 * i + 1, b)]
    for _, t in rows:
        w = t.split()
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)})
    alike = [len(sets[2 * i] & sets[2 * i + 1]) >= 0.8 * len(sets[2 * i] | sets[2 * i + 1]) for i in range(160)]
    assert alike == [i % 2 == 1 and i < 120 for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert got == {k for k, _ in rows if k % 2 == 0 or not alike[k // 2]}
    chain = [f"u{k}" for k in range(116)]
    shifted = [(k, " ".join(chain[8 * k : 8 * k + 100])) for k in range(3)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(shifted, "doc_id long, text string"), "").collect()
    assert [r["doc_id"] for r in got] == [0]  # 0 and 2 are linked through 1 only
