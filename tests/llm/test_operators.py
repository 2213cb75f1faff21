"""Operators on small fixtures: definitions, skewed inputs, general interfaces."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import common, jaccard, language, mixing, quality, topk
from plumbline.llm.components import components
from plumbline.llm.language import classifier
from plumbline.llm.line_dedup import drop_shared_lines
from plumbline.llm.pieces import PieceCoder
from plumbline.llm.shingles import PartEnum, shingle_set, similar
from plumbline.llm.token_counts import CountedText, TokenCounter
from plumbline.llm.tool_calls import canonical, faults, link_calls
from tests.llm.conftest import prose


def test_bad_hosts_take_their_documents_with_them(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "again and again and again"
    docs = [(i, good, "fine") for i in range(40)] + [(i, bad, "poor") for i in range(40, 70)] + [(70, good, "poor"), (71, bad, "tiny"), (72, good, "tiny"), (73, good, None)]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert got[0]["kept"] and not got[70]["kept"] and got[70]["host_failed"] and not got[70]["base_failed"]
    assert got[72]["kept"] and not got[71]["kept"], "one failure of two is shrunk towards the other hosts"
    assert got[73]["kept"] and got[0]["n_repeat_words"] == 0 and got[71]["n_repeat_words"] == 5


def test_beta_prior():
    a, b = quality.beta_prior(3, 300, 30, 3 * 10 * 10 / 100)
    assert a + b == pytest.approx(300) and a / (a + b) == pytest.approx(0.1), "equal rates: one host"
    a, b = quality.beta_prior(2, 200, 100, 100 * 100 / 100)
    assert a + b == pytest.approx(1), "all or nothing"
    assert quality.beta_prior(0, 0, 0, 0.0) == (0.5, 0.5)


@pytest.mark.parametrize("limit", (0, 10_000))
def test_mix_takes_each_target_exactly(spark, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", limit)
    rng = random.Random(1)
    docs = [(i, prose(rng, rng.randint(0, 60)), rng.choice("aaaaabcd")) for i in range(400)] + [(None, "x y", None)] * 3
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = mixing.mix(frame).toPandas()
    assert len(got) == len(docs) and (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    by = got.merge(frame.toPandas()[["doc_id", "source"]].drop_duplicates(), on="doc_id").drop_duplicates(["doc_id"]).groupby("source")
    for _, part in by:
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 0.5
    again = mixing.mix(frame.repartition(7)).toPandas()
    assert sorted(map(tuple, got.fillna(-1).values)) == sorted(map(tuple, again.fillna(-1).values))
    sampled = mixing.sample_mix(frame)
    assert sampled.columns == frame.columns
    assert sampled.count() == sum(-(-t // s) for t, s in zip(got.taken, got["size"]) if t > 0)


def test_lines_keep_other_columns(spark):
    line = "this line is shared by all of them"
    docs = spark.createDataFrame([(i, f"{i}\n{line}", i * 1.5, "x") for i in range(4)], "doc_id long, text string, `a.b` double, lost string")
    got = drop_shared_lines(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == [(i, f"{i}" if i < 3 else f"3\n{line}", i * 1.5, "x") for i in range(4)]


def test_similar_sets_share_a_signature():
    rng, scheme = np.random.default_rng(3), PartEnum(75)
    for trial in range(4000):
        n = int(rng.integers(1, 40) if trial % 2 else rng.integers(1, 700))
        one = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        out, more = rng.integers(0, n // 4 + 1), rng.integers(0, n // 4 + 1)
        two = np.unique(np.concatenate([rng.permutation(one)[out:], rng.integers(0, 2**64, more, dtype=np.uint64)]))
        if similar(one, two, 75):
            assert len(np.intersect1d(scheme.signatures(one), scheme.signatures(two))), (n, out, more)


def brute_classes(docs, percent=75):
    sets = {i: shingle_set(t.encode()) for i, t in docs}
    ids, label = sorted(sets), {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and similar(sets[a], sets[b], percent):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("limit", (0, 1_000_000))
def test_classes_are_those_of_all_pairs(spark, monkeypatch, limit):
    """Chains of edits, whose ends are unlike, beside a passage that many share: both rounds have work to do."""
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", limit)
    rng, docs = random.Random(4), []
    for _ in range(6):
        words = prose(rng, rng.choice((8, 40, 150, 400))).split()
        for _ in range(25):
            words = list(words)
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = prose(rng, 1)
            docs.append(" ".join(words))
    passage = prose(rng, 60)
    docs += [f"{prose(rng, rng.randint(8, 40))} {passage} {prose(rng, 8)}" for _ in range(60)]
    rng.shuffle(docs)
    rows = list(enumerate(docs))
    got = jaccard.similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_classes(rows)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want
    assert 12 < len(set(want.values())) < 120


def test_keep_one_of_each_keeps_columns(spark):
    docs = spark.createDataFrame([(3, "a b c d e f", "x"), (1, "a b c d e f", "y"), (2, None, None), (None, "a b c d e f", "z")], "doc_id long, text string, label string")
    got = jaccard.keep_one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(1, "a b c d e f", "y"), (2, None, None), (None, "a b c d e f", "z")]))


def test_join_frees_the_driver_after_each_of_its_jobs(spark, monkeypatch):
    """What a job broadcast must not wait on the driver for the jobs that come after it."""
    done, settle = [], common.settle
    monkeypatch.setattr(common, "settle", lambda *given: done.append("settled") or settle(*given))
    monkeypatch.setattr(common, "release", lambda session: done.append("released"))
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, text), (2, f"{text} thirteen"), (3, "a b c d e f")]
    got = jaccard.similar_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == [(1, 1), (2, 1), (3, 3)]
    assert len(done) > 20 and done == ["settled", "released"] * (len(done) // 2)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(160, 160)] + [(7, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(60)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_top_k_with_large_components_and_few_rows(spark):
    rows = [(0, [60000.5, -60000.25]), (50, [60000.0, 60000.0]), (7, [0.1, 0.1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = []
    for q in (0, 50):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, shard_rows=1)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


@pytest.fixture(scope="module")
def coder():
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return PieceCoder(file.read())


def test_pieces_of_random_texts(coder):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(8)
    parts = list("abcdefgh theinrst  \n\t▁éñß漢🙂\x00'.,0123") + ["  ", "the ", "ing", "   ", "<s>", "</s>", "<0x0A>"]
    cases = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    cases += [f(" " * n) for n in range(130) for f in (lambda s: s, lambda s: f"a{s}b", lambda s: f"{s}the")] + ["thinghaonre" * 3000]
    for text in cases:
        ids = library.encode(text, add_eos=True)
        assert coder.encode(text).tolist() == ids, repr(text)
        assert coder.decode(ids) == library.decode(ids), repr(text)


def test_edits_of_random_texts():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        counter = TokenCounter(file.read(), public_tokenizers.PATTERN)
    rng = random.Random(9)
    parts = list("abcdef  \n\t'.,!01é漢\x1c\x85🙂") + ["'ll", "'re", "'s", "  ", "the ", "   "]
    some = lambda n: "".join(rng.choices(parts, k=rng.randint(0, n)))
    for _ in range(1500):
        text = some(60)
        counted = CountedText(text, counter)
        for _ in range(5):
            start = rng.randint(-2, len(text) + 3)
            stop, new = start + rng.randint(-1, 12), some(8)
            counted.edit(start, stop, new)
            a = min(max(start, 0), len(text))
            text = text[:a] + new + text[min(max(stop, a), len(text)) :]
            assert counted.text() == text and counted.n_tokens == len(counter.coder.encode_ordinary(text))


def test_classifier_without_or_with_one_language():
    assert classifier({})("some text") == ("und", 0.0, 0.0)
    one = classifier({"en": b"the and of to in " * 20})
    assert one("the text") == ("en", 1.0, 1.0) and one("12 34")[0] == one(None)[0] == "und"


def test_calls_in_order_with_cycles_and_faults(spark):
    calls = [
        (1, 1, "a", "add", '{"x": 1.0, "b": "é\\u0001"}', []), (1, 3, "b", "add", '{"x": 2', ["a"]), (1, 2, "c", "none", "{}", ["b", "a", "gone"]),
        (1, 4, "d", "add", None, ["e"]), (1, 5, "e", "add", '{"x": NaN}', ["d"]), (1, 6, "f", "add", '{"x": 3}', ["e"]), (2, 1, "a", "add", '{"x": 500}', None), (2, 1, None, "add", "{}", None),
    ]
    results = [(1, "a", "two"), (1, "a", "one"), (1, "zz", "orphan"), (None, "a", "x")]
    schema = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "maximum": 9}}}}
    got = link_calls(
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>"),
        spark.createDataFrame(results, "conv_id long, call_id string, content string"), schema,
    )
    found = {(r["conv_id"], r["call_id"]): r for r in got.collect()}
    assert {k: r["level"] for k, r in found.items()} == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): -1, (1, "e"): -1, (1, "f"): -1, (2, "a"): 0}
    assert found[1, "a"]["valid"] and found[1, "a"]["n_results"] == 2
    assert found[1, "a"]["json"] == '{"arguments":{"b":"é\\u0001","x":1},"id":"a","name":"add","result":"one"}'
    assert [found[1, k]["errors"] for k in "bcde"] == ["$: not JSON", "unknown tool none", "$.x: missing", "$: not JSON"]
    assert found[2, "a"]["errors"] == "$.x: above maximum"


def test_canonical_order_and_schema_kinds():
    assert canonical({"\ufb33": 1, "\U0001f600": 2, "a": [1e3, 0.5, None, True]}) == '{"a":[1000,0.5,null,true],"\U0001f600":2,"\ufb33":1}'
    assert faults([1, "x"], {"type": "array", "items": {"type": ["integer", "null"]}}) == ["$[1]: not ['integer', 'null']"]
    assert faults({"a": 1}, {"properties": {}, "additionalProperties": False}) == ["$.a: not expected"]


def test_top_k_keeps_components_of_any_size(spark):
    rows = [(0, [2.0**40, 3.0]), (50, [5.0, 2.0**40]), (1, [7.0, -1.5]), (2, [-(2.0**30), 2.0**12]), (100, [2.0**26, 2.0**27]), (3, [2.0**26, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    asked = [(50, [0.5, 0.25]), (0, [0.25, 2.0])]
    queries = spark.createDataFrame(asked, "vec_id long, embedding array<double>")
    want = []
    for q, v in asked:
        w = [int(np.floor(256 * x)) for x in v]
        scored = sorted((-sum(a * b for a, b in zip(w, whole[i])), i) for i in whole if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(map(tuple, topk.top_k(vectors, queries, 5, shard_rows=2).collect())) == sorted(want)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(vectors, vectors.where("vec_id = 0"), 5).collect()


def test_top_k_over_many_cells_copies_and_lengths(spark):
    draw = np.random.default_rng(1)
    around = draw.normal(size=(6, 8))
    rows = [(i, around[0]) for i in range(500)] + [(i, around[draw.integers(6)] + 0.3 * draw.normal(size=8)) for i in range(500, 1400)]
    rows += [(i, draw.normal(size=3)) for i in range(1400, 1500)]  # shards of another length
    rows += [(7, rows[7][1])] * 12 + [(9000, rows[800][1])] * 9 + [(800, rows[800][1])] * 3 + [(9001, np.ones(1)), (9050, np.ones(0))]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>").repartition(7)
    whole, want = [(i, np.floor(256 * v).astype(np.int64)) for i, v in rows], []
    for q, v in {i: v for i, v in whole if i % 50 == 0}.items():
        scored = sorted((-int(v @ w), i) for i, w in whole if i != q and len(w) == len(v))[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, shard_rows=32)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_cells_that_cannot_reach_the_floor_are_not_visited():
    near, far = np.array([[10.0, 0.0]]), np.array([[-10.0, 0.0]])
    balls = {2: (np.concatenate([far, near]) * 256, np.array([1.0, 1.0]), np.array([0, 3]), np.array([3, 2]))}
    asked = pa.RecordBatch.from_pylist([{"id": 4, "vec": [1.0, 0.0], "floor": None}, {"id": 5, "vec": [1.0, 0.0], "floor": 600_000}])
    shards = lambda since, until: [(r["id"], r["shard"]) for b in topk.visits(balls, since, until)(iter([asked])) for r in b.to_pylist()]
    assert shards(0, 1) == [(4, 3), (5, 4)]
    assert shards(1, 4) == [(4, 4), (4, 1), (4, 2), (5, 3)]
    assert shards(4, None) == [(4, 0)]


def test_deep_chains_and_branches_have_their_levels(spark):
    calls = [(1, t, f"c{t}", "search", "{}", [f"c{t - 1}"] if t else []) for t in range(300)]  # a chain
    calls += [(2, t, f"c{t}", "search", "{}", [f"c{p}" for p in {t // 2, t - 1, t - 7} if 0 <= p < t]) for t in range(40)]  # several dependencies
    calls += [(3, t, f"c{t}", "search", "{}", [f"c{(t + 1) % 5}"] if t < 5 else [f"c{t - 1}"]) for t in range(9)]  # a circle and what is behind it
    frame = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([], "conv_id long, call_id string, content string")
    got = {(r["conv_id"], r["turn"]): r["level"] for r in link_calls(frame, results, {}).collect()}
    want = {(1, t): t for t in range(300)} | {(3, t): -1 for t in range(9)}
    for t in range(40):
        want[2, t] = max((want[2, p] + 1 for p in {t // 2, t - 1, t - 7} if 0 <= p < t), default=0)
    assert got == want


def test_languages_by_sizes_computed_apart(spark):
    """Dictionaries and sizes from their definition: samples by hash, blocks compressed with a dictionary each."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    extra = [(9001, "½ ² Ⅷ 123 ¼", "en"), (9002, "١٢٣ ⑦", "de"), (9003, None, "en"), (9004, "", "en"), (9005, "ª", None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).cache()
    learned = [r for r in docs.withColumn("key", F.xxhash64("doc_id", "text")).collect() if r["lang"] and r["text"] and re.search(r"[^\W\d_]", r["text"])]
    known = {}
    for r in sorted(learned, key=lambda r: (r["lang"], r["key"])):
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["doc_id"] < 9000:
            known.setdefault(r["lang"], []).append(re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+", b" ", r["text"][:100].lower().encode()).strip())
    dictionaries = {lang: b" ".join(parts) for lang, parts in known.items()}
    assert dictionaries == language.learn(docs)
    wrong = 0
    for r in language.identify(docs, dictionaries).join(docs, "doc_id").collect():
        if r["doc_id"] >= 9000:
            assert (r["lang_pred"] == "und") == (r["doc_id"] != 9005), r["doc_id"]
            continue
        raw = re.sub(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+", b" ", r["text"].lower().encode()).strip()
        raw = b" ".join([raw] * (1 if len(raw) >= 256 else 256 // (len(raw) + 1) + 1))
        sizes = {}
        for lang, content in dictionaries.items():
            how = zstandard.ZstdCompressionParameters.from_level(9, source_size=4096, dict_size=len(content), write_content_size=False, strategy=zstandard.STRATEGY_LAZY2, min_match=4, search_log=4)
            coder = zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            sizes[lang] = sum(len(coder.compress(raw[i : i + 4096])) for i in range(0, len(raw), 4096))
        wrong += r["lang_pred"] != min(sizes, key=lambda k: (sizes[k], k))
    assert wrong == 0
