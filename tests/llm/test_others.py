import bisect
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from recordloom.llm import decontaminate, eliasfano, packing, quality, queries, shards, tokens, topk, toxicity, urlrules

V = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "a", " ", "  ", "   ", " a", "a ", "a  b", "a   b", "\n a", "a\n ", "a\n b", "a \nb", "it's 's  'll", "   x", "a\t b", "x<|endoftext|>y", "é  è\r\n q",
       "日本 語  テ", "a \n", "\n", "\na", "a\n", "a.\nB c, d.", "\n. x", "3.14. 5,", "a*** b%%% ''. '", "don't. it's, 's. ", "x\n.y\n", "a\n\nb", "!! a!!\n!!", "\u00a0x. y\u00a0", "१."]
rng = np.random.default_rng(3)


def test_encoder_is_the_library():
    from tokenizers import Tokenizer

    e, library = tokens.Encoder(V, cache_limit=20), Tokenizer.from_file(V)
    assert library.encode("x<|endoftext|>y", add_special_tokens=False).ids == [87, 50256, 88]
    for t in ODD + [" ".join(rng.choice(ODD, 9)) for _ in range(300)]:
        assert np.frombuffer(e.encode(t), e.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert e.encode(None) == b""


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_elias_fano(n):
    for top in (1, 5, n + 1, 10**6, 2**40):
        v = np.sort(rng.integers(0, top, n))
        code = eliasfano.EliasFano(eliasfano.encode(v))
        assert (code.range(0, n) == v).all() and all(code[i] == v[i] for i in rng.integers(0, n, 5 if n else 0))
        assert all((code.range(s, min(n, s + 300)) == v[s : s + 300]).all() for s in range(0, n, 170))
        assert n < 3000 or code.size * 8 < n * (4 + max(0, np.log2(top / n))) + 1000


def documents(spark):
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(ODD)), ODD)] + [(900, None), (901, "word " * 3000), (901, "again"), (902, "x" * 5000)]
    return rows, spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, start int").repartition(3)


def test_shards_round_trip(spark):
    rows, df = documents(spark)
    lib = tokens.Encoder(V).library
    manifest = shards.write_shards(df, V, 2, shards=3)
    got = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in shards.read_shards(spark, manifest, 4).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted(i for i, _ in rows)
    at = 0
    for i, start, ids in got:
        assert start == at and ids in [np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for k, t in rows if k == i]
        at += len(ids) // 4
    assert len({bytes(g[2]) for g in got if g[0] == 901}) == 2
    assert shards.read_shards(spark, shards.write_shards(df.limit(0), V, 2)).count() == 0
    with pytest.raises(Exception):
        shards.write_shards(df.withColumn("doc_id", F.lit(None).cast("long")), V, 2)


def test_packing(spark):
    rows, df = documents(spark)
    got = packing.pack(df, V, 0, 256).toPandas()
    lib = tokens.Encoder(V).library
    whole = {}
    for i, t in rows:
        whole.setdefault(i, []).append(lib.encode(t or "", add_special_tokens=False).ids + [0])
    assert got["length"].sum() == sum(len(x) for xs in whole.values() for x in xs)
    for r in got.itertuples():
        assert any(zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in whole[r.doc_id])
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 256
    assert got[got.doc_id == 902].sort_values("piece")["length"].iloc[1:].eq(256).all()
    assert packing.pack(df.limit(0), V).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_capacity(rule):
    histogram = {int(k): int(n) for k, n in zip(range(1, 257), rng.integers(0, 90, 256)) if n}
    plan = packing.Plan({k: n for k, n in histogram.items() if k * k <= 40_000}, 256, 6, 40_000, rule=rule)
    bins: dict[int, list] = {}
    for k, n in histogram.items():
        if k * k <= 40_000:
            s, o = plan.places(np.full(n, k), np.arange(n))
            for x, y in zip(s, o):
                bins.setdefault(int(x), []).append((int(y), k))
    for items in bins.values():
        items.sort()
        assert sum(k for _, k in items) <= 256 and len(items) <= 6 and sum(k * k for _, k in items) <= 40_000
        assert [o for o, _ in items] == list(np.cumsum([0, *(k for _, k in items)])[:-1])
    free = packing.Plan(histogram, 256, 256, 65_536, (1.0, 0.0, 0.0), "norm")
    rooms: list[int] = []  # best fit decreasing, one piece at a time
    opened = 0
    for k in sorted(histogram, reverse=True):
        for _ in range(histogram[k]):
            i = bisect.bisect_left(rooms, k)
            opened += i == len(rooms)
            bisect.insort(rooms, (rooms.pop(i) if i < len(rooms) else 256) - k)
    assert free.sequences == opened
    assert packing.Plan(histogram, 256, 256, 65_536, rule=rule).sequences <= opened * (1.0 if rule == "norm" else 1.01)


def test_top_k_is_brute_force(spark):
    x = rng.integers(-40, 40, (300, 16))
    x[50:150] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (None, [1] * 16), (401, [0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(4)
    got = topk.top_k(df, df.where("vec_id % 20 = 0 or vec_id = 401"), 7).toPandas()
    ids = np.array([i for i, v in rows if i is not None and v], int)
    table = np.array([v for i, v in rows if i is not None and v])
    for q in [*range(0, 300, 20), 401]:
        s = table @ table[ids == q][0]
        want = [(int(ids[i]), int(s[i])) for i in np.lexsort((ids, -s)) if ids[i] != q][:7]
        g = got[got.query_id == q].sort_values("rank")
        assert list(zip(g.vec_id, g.score)) == want and g["rank"].tolist() == list(range(1, 8))
    assert topk.top_k(df.limit(0), df, 3).count() == 0
    bad = spark.createDataFrame([(1, [float("nan")]), (2, [None]), (3, None), (4, [0.99, -0.01])], "i long, e array<float>")
    assert [r["v"] for r in bad.select(topk.quantised("e").alias("v")).collect()] == [None, None, None, [63, -1]]


def test_top_k_sends_a_vector_to_few_cells(spark, monkeypatch):
    own = np.random.default_rng(9)  # a generator of its own: the other tests' numbers stay as they are
    x = own.integers(-40, 40, (600, 8))
    x[100:160] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<long>").repartition(3)
    real, seen = type(df).repartition, []
    monkeypatch.setattr(type(df), "repartition", lambda self, *how: (seen.append(self), real(self, *how))[1])
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 32)
    monkeypatch.setattr(topk, "LISTED", 50, raising=False)  # so a cell has several sets of lists
    got = topk.top_k(df, df, 5).toPandas().sort_values(["query_id", "rank"])
    score = x @ x.T
    for q, g in got.groupby("query_id"):
        want = [i for i in np.lexsort((np.arange(600), -score[q])) if i != q][:5]
        assert g.vec_id.tolist() == want and g.score.tolist() == score[q][want].tolist()
    assert len(got) == 3000
    assert seen[0].agg(F.sum(F.length("rows"))).first()[0] <= 16 * x.size  # a byte a component is enough for these


def test_threshold_stops_early():
    x = np.abs(rng.integers(0, 5, (4000, 8)))
    x[7] = 60
    _, _, scored = topk.Lists(np.arange(4000), x).search(np.full(8, 9), -1, 1)
    assert scored < 400


def judged(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest, re.S).group()
    path = re.match(r"[^?#]*", rest[len(host) :], re.S).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for r, v in queries.RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


def test_urls_are_brute_force(spark):
    urls = [None, "", "nonsense", "http://net", "http://NET/", "x://network/", "x://.net/q?", "x://a.example.net/en/\n#", "x://example.net/en", "http://org/fr/1", "//net/", "x://Éxample.COM/de/é", "x://a.b.c.d.example.net/en/" + "z" * 20_000]
    urls += [f"http://{h}{p}" for h, p in itertools.product(["a.net", "example.net", "m.example.com", "z.org"], ["", "/", "/en/", "/de/1", "/fr/?x", "#/fr/"])] + ["http://hot.net/1"] * 500
    df = spark.createDataFrame([(None if i == 4 else i // 2, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string").repartition(5)
    rules = urlrules.rule_table(spark, queries.RULES + [("net/", "allow")])
    got = sorted((tuple(r) for r in urlrules.judge(df, rules).collect()), key=str)
    assert got == sorted(((r["page_id"], *judged(r["url"])) for r in df.collect()), key=str)
    assert urlrules.judge(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urlrules.judge(df, rules.limit(0)).collect()} == {"allow"}


def test_decontamination(spark):
    item = [f"t{i}" for i in range(40)]
    swapped = [w if i % 6 else "zz" for i, w in enumerate(item)]
    noise = lambda n: [f"n{i}" for i in rng.integers(0, 5000, n)]
    rows = [(1, " ".join(noise(50) + item + noise(50))), (2, " ".join(noise(20) + swapped + noise(9))), (3, " ".join(noise(90))), (4, " ".join(item[:9] + noise(30) + item[9:17])), (5, ""), (6, None), (7, " ".join(item[10:25]).upper() + "."), (1, "x")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, hits int")
    bench = spark.createDataFrame([(9, " ".join(item)), (10, None), (11, "a b"), (9, " ".join(item)), (12, "q1 - q2 q3"), (13, "")], "item_id long, text string")
    got = decontaminate.contaminated(df, bench).select("doc_id", "item_id").distinct().collect()
    assert sorted(map(tuple, got)) == [(1, 9), (2, 9), (7, 9)]
    kept = decontaminate.clean(df, bench)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 6]
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0 and decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_every_allowed_substitution_is_found():
    """Of items of each length, and of an overlap of 13 tokens within longer ones, with as many substitutions as are allowed."""
    for n in [*range(1, 15), 30]:
        own = [f"i{k}" for k in range(n)]
        seeds = decontaminate.Seeds([(1, " ".join(own))], 13, 0.8)
        size = min(n, 13)
        wrong = 0 if n < 6 else size - int(np.ceil(0.8 * size - 1e-9))
        for spots in itertools.combinations(range(size), wrong):
            part = ["x" if k in spots else w for k, w in enumerate(own[:size])]
            assert seeds.hits("a b " + " ".join(part) + " c"), (n, spots)
        if wrong:
            assert not seeds.hits(" ".join(["x" if k <= wrong else w for k, w in enumerate(own[:size])]))


def test_op5_is_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], decontaminate.tokens(r["text"] or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = set()
    for item, y in [(r["item_id"], decontaminate.tokens(r["text"] or "")) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]:
        need = min(13, len(y))
        known = set(y)
        for i, x in docs:
            if sum(w in known for w in x) < 0.8 * need:
                continue
            for d in range(-len(y) + need, len(x) - need + 1):
                same = [x[d + k] == y[k] if 0 <= d + k < len(x) else None for k in range(len(y))]
                run = [s for s in same if s is not None]
                if need and any(sum(run[k : k + need]) >= (need if len(y) < 6 else 0.8 * need - 1e-9) for k in range(len(run) - need + 1)):
                    want.add((i, item))
                    break
    got = {(r["doc_id"], r["item_id"]) for r in queries.op5_benchmark_decontamination(spark, sf).collect()}
    assert got == want and want


def test_string_kernel():
    def brute(s, t, p=3):
        pairs = itertools.product(itertools.combinations(range(len(s)), p), itertools.combinations(range(len(t)), p))
        return sum(toxicity.DECAY ** (i[-1] - i[0] + j[-1] - j[0] + 2) for i, j in pairs if all(s[a] == t[b] for a, b in zip(i, j)))

    for a, b in (("idiot", "i-d-iot"), ("abcabc", "cabbac"), ("loser", "closer"), ("aaa", "aaaa")):
        (x, _), (y, _) = toxicity._codes([a]), toxicity._codes([b])
        assert toxicity.subsequence_kernel(x, y)[0] == pytest.approx(brute(f"^{a}$", f"^{b}$"), rel=1e-4)


def labelled(spark):
    syllables = ["ka", "to", "mi", "re", "su", "no", "ela", "ir"]
    word = lambda: "".join(rng.choice(syllables, int(rng.integers(1, 4))))
    rows, labels = [], []
    for i in range(600):
        text = [word() for _ in range(60)]
        toxic, good = i % 5 == 0, i % 3 > 0
        if toxic:
            text[20] = ["vexblag", "vexblagun", "drulfop"][i // 5 % 3]
        if not good:
            text = [w + "***" for w in text]
        rows.append((i, " ".join(text) + ".", 3.0))
        if i < 560:
            labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame(rows + [(601, "", 0.0), (602, None, 0.0), (603, "vex-blag v e x b l a g", 0.0)], "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifiers_hold_out(spark):
    docs, labels = labelled(spark)
    learn = queries.fold(4) != 2
    for make, of in ((toxicity.toxicity_score, lambda i: i % 5 == 0), (quality.quality_score, lambda i: i % 3 > 0)):
        score = make(docs, labels, learn)
        got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", score(F.col("text")).alias("s")).collect()}
        assert len(got) == 603 and all(0 <= s <= 1 for s in got.values())
        right = [(got[i] >= 0.3) == of(i) for i in range(600)]
        assert sum(right) >= 590
        none = make(docs, labels.limit(0), learn)
        assert docs.select(none(F.col("text")).alias("s")).distinct().count() == 1
        if make is toxicity.toxicity_score:
            assert got[603] >= 0.3 and got[601] < 0.3 and got[602] < 0.3


def test_letters_in_several_gaps_are_found():
    own, syllables = np.random.default_rng(3), ["ka", "to", "mi", "re", "su", "no", "ela", "ir"]
    word = lambda: "".join(own.choice(syllables, int(own.integers(1, 4))))
    insults, sample = ["idiot", "trash", "moron", "scumbag"], []
    for i in range(600):
        text = [word() for _ in range(40)] + ["thrasph"] * (i % 7 == 1 and i % 5 > 0)
        sample.append((" ".join(text[:20] + [insults[i // 5 % 4]] * (i % 5 == 0) + text[20:]), int(i % 5 == 0)))
    model = toxicity.Model(sample)
    rest = " ".join(word() for _ in range(10))
    bad = ["idqiqot", "trxaxsh", "ixdxixoxt", "iadbicodt", "mxoxrxoxn", "sxcxuxmxbxaxg", "Scxumxba.xg!"]
    assert [w for w, s in zip(bad, model.scores([f"{rest} {w} {rest}" for w in bad])) if s < 0.3] == []
    good = ["thrasph", "mormonism", "indication", rest]
    assert [w for w, s in zip(good, model.scores([f"{rest} {w} {rest}" for w in good])) if s >= 0.3] == []


def test_first_words_are_encoded_once():
    """And as the library encodes them, before and after they are forgotten."""
    from recordloom.llm.queries import vocabulary
    from recordloom.llm.tokens import Encoder

    e, asked = Encoder(vocabulary()), []
    e.fast = lambda texts, f=e.fast, **how: asked.extend(texts) or f(texts, **how)
    texts = ["The cat sat", "The dog\nran off", "\nAn end", "x" * 50 + " y", "The"]
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(e.encode(t), e.dtype).tolist() == e.library.encode(t, add_special_tokens=False).ids
    assert asked.count("The") == 1


def test_parts_are_looked_up_and_asked_for_once():
    from recordloom.llm.queries import vocabulary
    from recordloom.llm.tokens import Encoder

    class Counted(dict):
        n = 0

        def get(self, *key):
            Counted.n += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counted.n += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            Counted.n += 1
            return super().__contains__(key)

    e, asked = Encoder(vocabulary()), []
    ask, e.fast = e.fast, lambda texts, **how: (asked.append(texts), ask(texts, **how))[1]
    text = "one two, three\nfour five\nsix: ünder"
    whole = np.array(e.library.encode(text, add_special_tokens=False).ids, e.dtype).tobytes()
    e.encode("one two,")
    asked.clear()
    assert e.encode(text) == whole and len(asked) <= 2  # what is new, after spaces and after line breaks, and a mark
    e.parts = Counted(e.parts)
    asked.clear()
    assert e.encode(text) == whole and not asked and Counted.n == 6  # a part each
    e.cache_limit, e.parts = 0, dict(e.parts)
    for more in (" seven two,", "\neight four", " nine"):  # what is remembered moves on within a text
        t = text + more
        assert e.encode(t) == np.array(e.library.encode(t, add_special_tokens=False).ids, e.dtype).tobytes()
