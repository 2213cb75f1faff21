"""Every stage of the corpus pipeline against brute force over the rows its predecessor kept."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from plumbline.llm import language
from tests.llm.test_operators import brute_classes

BLANKS = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def languages(docs, frame):
    classify = language.classifier(language.learn(frame))
    judged = [(d, classify(d["text"])) for d in docs]
    return [d for d, (lang, _, margin) in judged if lang != "und" and margin >= language.MARGIN]


def line_keys(text):
    return [line.strip(BLANKS).translate(FOLD) for line in (text or "").split("\n")]


def without_shared_lines(docs, frame):
    holders = {}
    for d in docs:
        for key in line_keys(d["text"]):
            if len(key) >= 20 and d["doc_id"] is not None:
                holders.setdefault(key, set()).add(d["doc_id"])
    kept = []
    for d in docs:
        lines = zip((d["text"] or "").split("\n"), line_keys(d["text"]))
        stays = [t for t, k in lines if d["doc_id"] is None or len(holders.get(k, ())) < 3 or d["doc_id"] == max(holders[k])]
        kept.append({**d, "text": "\n".join(stays), "n_chars": len("\n".join(stays))})
    return kept


def one_of_each(docs, frame):
    classes = brute_classes([(d["doc_id"], d["text"] or "") for d in docs])
    return [d for d in docs if classes[d["doc_id"]] == d["doc_id"]]


def mixed(docs, frame):
    sizes = [len([w for w in (d["text"] or "").translate(str.maketrans(BLANKS, " " * 6)).split(" ") if w]) for d in docs]
    names = sorted({d["source"] for d in docs if d["source"] is not None}) + ([None] if any(d["source"] is None for d in docs) else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(n for d, n in zip(docs, sizes) if d["source"] == s) for s in names}
    target, full = {}, set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 2 * total[s] if s in full else left * weight[s] / share for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * total[s]}
        if not over:
            break
        full |= over
    out = []
    for s in names:
        group = [(hashlib.md5(f"7|{d['doc_id']}|{d['text'] or ''}".encode()).hexdigest(), n, d) for d, n in zip(docs, sizes) if d["source"] == s]
        whole = int(target[s] // total[s]) if total[s] else 0
        left = round(target[s] - whole * total[s])
        for _, n, d in sorted(group, key=lambda g: g[0]):
            taken = whole * n + max(0, min(n, left))
            left -= n
            out += [d] * (-(-taken // n) if n else 0)
    return out


def tokens(docs, frame):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for d in docs:
        ids = library.encode(d["text"] or "", add_eos=True)
        out.append({"doc_id": d["doc_id"], "n_tokens": len(ids), "ids": ids, "decoded_sha256": hashlib.sha256(library.decode(ids).encode()).hexdigest()})
    return out


BRUTE = {"language_id": languages, "line_dedup": without_shared_lines, "jaccard_join": one_of_each, "mixing": mixed, "sentencepiece": tokens}


@pytest.fixture(scope="module")
def by_stage(spark, sf, tmp_path_factory):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, frame, sf).write.parquet(path)
        found.append((name, frame, spark.read.parquet(path)))
        frame = found[-1][2]
    return found


def test_stages_match_brute_force(by_stage):
    assert [name for name, _, _ in by_stage] == list(BRUTE)
    for name, before, after in by_stage:
        want = BRUTE[name]([r.asDict() for r in before.collect()], before)
        got = [r.asDict() for r in after.collect()]
        assert Counter(map(repr, (sorted(d.items()) for d in got))) == Counter(map(repr, (sorted(d.items()) for d in want))), name
        if name != "sentencepiece":
            assert after.columns == before.columns, name


def test_run_is_the_stages(spark, sf, by_stage):
    got = corpus_pipeline.run(spark, sf).select("doc_id", "n_tokens")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, by_stage[-1][2].select("doc_id", "n_tokens").collect()))


@pytest.mark.parametrize("where", ("hostile", "empty"))
def test_stages_take_anything(spark, request, where):
    got = corpus_pipeline.run(spark, request.getfixturevalue(where))
    assert (got.count() > 0) == (where == "hostile")


def test_the_driver_lets_go_between_stages(spark, tmp_path, monkeypatch):
    """What a stage leaves on the driver is collected before the next one: its heap does not fill with plans of all stages."""
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    done = []
    monkeypatch.setattr(corpus_pipeline, "release", lambda session: done.append("released"))
    stages = [(name, lambda spark, docs, d, name=name: done.append(name) or docs) for name in ("one", "two", "last")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 2
    assert done == ["one", "released", "two", "released", "last"]
