"""The pipeline on a small folder of tables, stage by stage."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from folioframe.llm import packing
from tests.llm.conftest import SCHEMA, make_docs
from tests.llm.test_texts import WORDS, base_spans, shingles


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(*r[:4], len(r[1] or ""), *r[5:]) for r in make_docs() if r[0] != 42]  # whose spans only the method adds
    rows += [(500 + k, f"an idiot and a moron said number {k} " + f"word{k} " * 9, "en", "s1", 50, None, None, None, None) for k in range(40)]
    rows += [(600 + k, " ".join(f"t{k}x{j}" for j in range(20)), "en", "s2", 50, None, None, None, None) for k in range(40)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(500 <= k < 600)) for k in range(30, 640) if k >= 500 or k < 45], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    clean = corpus_pipeline.reject_toxic(spark, docs, folder)
    ids = {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert clean.columns == columns and not ids & set(range(500, 540)) and set(range(600, 640)) <= ids and set(range(13)) <= ids
    one = corpus_pipeline.keep_one_of_similar(spark, clean, folder)
    kept = [r["doc_id"] for r in one.collect()]
    assert one.columns == columns and kept.count(8) == 1 and 9 not in kept and 10 not in kept and {0, 1, 2} <= set(kept) and kept.count(None) == 2
    masked = corpus_pipeline.mask_personal_data(spark, one, folder)
    assert masked.columns == columns and masked.count() == len(kept) and masked.where("text like '%@%'").count() == 0
    mixed = corpus_pipeline.mix_sources(spark, masked, folder)
    assert mixed.columns == columns and 0 < mixed.count() <= 2 * len(kept)
    packed = corpus_pipeline.pack(spark, mixed, folder)
    assert packed.where("start = 0").count() == mixed.count()


def test_run(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "pii", "mixing", "packing"]
    assert corpus_pipeline.run(spark, folder).count() > 0


def brute(rows, toxic_ids):
    """The documents after each stage but the last, by plain Python; the toxicity model's verdicts are given."""
    clean = [r for r in rows if r[0] not in toxic_ids]
    sets = [shingles(r[1]) for r in clean]
    parent = list(range(len(clean)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(clean)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(clean):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    one, seen = [], set()
    for k, r in enumerate(clean):
        if r[0] is None:
            one.append(r)
        elif least[find(k)] == r[0] and r[0] not in seen:
            seen.add(r[0])
            one.append(r)
    masked = []
    for r in one:
        text, spans = r[1], base_spans(r[1])
        if spans:
            out, at = "", 0
            for a, kind, b in spans:
                if a >= at:
                    out += text[at:a] + ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"][kind]
                at = max(at, b)
            text = out + text[at:]
        masked.append((r[0], text, r[3]))
    size = Counter()
    for _, t, s in masked:
        size[s] += len(WORDS.findall(t or ""))
    order = sorted(s for s in size if s is not None) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, budget, free = {}, 1.5 * sum(size.values()), set(order)
    while True:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if 2 * size[s] < level * weight[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        free -= over
    target |= {s: level * weight[s] for s in free}
    h = lambda k: int(hashlib.md5(str("" if k is None else k).encode()).hexdigest()[:15], 16)
    mixed = []
    for k, t, s in masked:
        whole = int(target[s] // size[s]) if size[s] else 0
        upto = sum(len(WORDS.findall(x or "")) for j, x, z in masked if z == s and h(j) <= h(k))
        mixed += [(k, t)] * (whole + (upto <= target[s] - whole * size[s]))
    return mixed


def test_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    clean = corpus_pipeline.reject_toxic(spark, docs, folder)
    toxic = {r[0] for r in rows} - {r["doc_id"] for r in clean.collect()}
    expected = Counter((k, len(tokens(t))) for k, t in brute(rows, toxic))
    got = Counter((r["doc_id"], r["doc_tokens"]) for r in corpus_pipeline.run(spark, folder).where("start = 0").collect())
    assert got == expected


def tokens(text):
    encoder = packing.load_encoder(packing.default_ranks())
    return [*encoder.encode_ordinary(text or ""), 1]


def test_unlike_documents_of_one_id_stay(spark):
    words = lambda k: " ".join(f"{k}w{i}" for i in range(30))
    rows = [(1, words("a")), (1, words("b")), (1, words("b")), (2, words("a")), (3, words("c")), (3, words("c") + " more"), (None, words("a")), (4, None), (4, None), (5, None), (6, "")]
    docs = spark.createDataFrame([(k, t, "s") for k, t in rows], "doc_id long, text string, source string")
    got = corpus_pipeline.keep_one_of_similar(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:2]) for r in got) == [(0, "aw"), (1, "aw"), (1, "bw"), (3, "cw"), (4, ""), (5, ""), (6, "")]
