"""Near duplicates, long repeats, language model, classifier, neighbours, packing and the pipeline against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import tuples
from llm.conftest import ODD
from pyspark.sql import functions as F

from ratestrata.llm import interpolated_lm, long_repeats, near_duplicates, neighbours, packing, quality_classifier
from ratestrata.llm.components import connected_components

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def varied(n, seed=1):
    """Texts with copies, near copies in chains, shared passages and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5 or not out:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 20, 80, 120]))]
        else:
            words = list(rng.choice(out))
            for _ in range(int(len(words) * rng.choice([0, 0, 0.02, 0.04, 0.06]))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if kind > 0.9:
            at = rng.randrange(len(words) + 1)
            words = words[:at] + passage[rng.randrange(20) : 40 + rng.randrange(20)] + words[at:]
        out.append(words)
    return [(100 + i, " ".join(words)) for i, words in enumerate(out)]


def components(rows, width):
    sets = {}
    for i, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        shingles = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        sets.setdefault(i, shingles)
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(i, len({tuple(s) for s in sets[i]}), find(i) if i is not None else None) for i, _ in rows]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_all_pairs(documents, width):
    rows = ODD + varied(220)
    found = near_duplicates.near_duplicates(documents(*rows), width)
    assert tuples(found.select("doc_id", "n_shingles", "component_id")) == sorted(components(rows, width), key=str)


def test_one_of_each_group_stays_with_all_columns(documents, no_documents):
    rows = ODD + varied(60, seed=4)
    docs = documents(*rows)
    kept = near_duplicates.one_per_group(docs, 5)
    assert kept.schema == docs.schema
    wanted = sorted(i for i, _, c in components(rows, 5) if i is not None and i == c)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(wanted))
    assert kept.where("doc_id is null").count() == 1
    assert near_duplicates.near_duplicates(no_documents).count() == 0


@pytest.mark.parametrize("percent", [0, 50, 79, 101])
def test_similarities_the_distance_is_not_made_for_are_refused(documents, percent):
    for operator in (near_duplicates.near_duplicates, near_duplicates.one_per_group):
        with pytest.raises(ValueError, match="percent must be 80 to 100"):
            operator(documents((1, "a")), percent=percent)


def test_signatures_rarely_exceed_the_distance():
    rng = np.random.default_rng(0)
    for size in (5, 40, 1000):
        common = rng.integers(0, 1 << 64, (200, 4 * size), dtype=np.uint64)
        own = rng.integers(0, 1 << 64, (200, size), dtype=np.uint64)
        a = near_duplicates.signatures([np.unique(c) for c in common])
        b = near_duplicates.signatures([np.unique(np.concatenate([c, o])) for c, o in zip(common, own)])
        differing = (a != b).sum(axis=1)
        assert differing.max() <= near_duplicates.MOST_DIFFERENT and abs(differing.mean() - 16) < 2


def test_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (300, near_duplicates.SLOTS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(near_duplicates.SLOTS, near_duplicates.MOST_DIFFERENT, replace=False)] += 1
    assert (near_duplicates.chunk_keys(a) == near_duplicates.chunk_keys(b)).any(axis=1).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = connected_components(spark, spark.createDataFrame(edges, "a long, b long"))
    assert tuples(found) == sorted(((x, find(x)) for x in root), key=str)
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def without_repeats(rows, window=13):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, own in words:
        if i is not None:
            for k in range(len(own) - window + 1):
                key = tuple(own[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, own in words:
        gone = set()
        for k in range(len(own) - window + 1) if i is not None else ():
            if first[tuple(own[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, own, [w for k, w in enumerate(own) if k not in gone]))
    return out


def test_long_repeats_equal_brute_force(documents, no_documents):
    rows = ODD + varied(150, seed=2)
    wanted = without_repeats(rows)
    digests = sorted(((i, len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, w, k in wanted), key=str)
    assert tuples(long_repeats.removal_digests(documents(*rows))) == digests
    docs = documents(*rows)
    cut = long_repeats.without_repeats(docs)
    assert cut.schema == docs.schema
    texts = [(i, t if len(w) == len(k) else " ".join(k)) for (i, t), (_, w, k) in zip(rows, wanted)]
    assert tuples(cut.select("doc_id", "text")) == sorted(texts, key=str)
    assert cut.where("n_chars != coalesce(char_length(text), n_chars)").count() == 0
    assert long_repeats.removal_digests(no_documents).count() == 0


def test_spans_point_at_the_same_words(documents):
    rows = varied(100, seed=5)
    words = {i: t.split() for i, t in rows}
    spans = long_repeats.repeated_spans(documents(*rows)).collect()
    assert spans
    for s in spans:
        assert s.source < s.doc_id and s.length >= 13
        assert words[s.doc_id][s.start : s.start + s.length] == words[s.source][s.source_start : s.source_start + s.length]


def mixture_by_hand(rows, order):
    """Scores by plain dictionaries: counts, expectation-maximisation per context class, and the mixture."""
    end = "\0end"
    texts = [(i, WORD.findall((t or "").translate(LOWER)) + [end]) for i, t in rows]
    fold = {i: 6 if i is None else zlib.crc32(str(i).encode()) % 5 for i, _ in rows}

    def grams(words):
        """For each token its n-grams of one word, two words, ...; None where the text is too short."""
        for at in range(len(words)):
            out = [(words[at],)]
            for k in range(1, order):
                if k == 1 or at >= k - 1:
                    before = words[max(0, at - k) : at]
                    out.append(tuple([end] * (k - len(before)) + before + [words[at]]) if len(before) >= k - 1 else None)
                else:
                    out.append(None)
            yield out

    def counted(folds):
        return Counter(g for i, words in texts if fold[i] in folds for out in grams(words) for g in out if g)

    def estimates(out, counts, n, v):
        seen = [counts[g[:-1]] if g else 0 for g in out[1:]]
        own = [counts[g] if g else 0 for g in out]
        longest = max((k + 1 for k, c in enumerate(seen) if c), default=0)
        group = 0 if not longest else (longest - 1) * 64 + int(math.log2(seen[longest - 1])) + 1
        return group, longest, [own[k] / max(seen[k - 1], 1) for k in range(order - 1, 0, -1)] + [own[0] / max(n, 1)]

    kept, total = counted({2, 3, 4}), counted({0, 2, 3, 4})
    n_kept = sum(len(w) for i, w in texts if fold[i] in {2, 3, 4})
    n = sum(len(w) for i, w in texts if fold[i] in {0, 2, 3, 4})
    v = len({g for g in total if len(g) == 1})
    cells = {}
    for i, words in texts:
        if fold[i] == 0:
            for out in grams(words):
                group, longest, parts = estimates(out, kept, n_kept, v)
                ratio = tuple(2.0 ** (max(-160, min(160, round(math.log2(x * (v + 1)) * 4))) / 4) if x > 0 else 0.0 for x in parts) + (1.0,)
                cells.setdefault((group, longest), Counter())[ratio] += 1
    weights = {}
    for (group, longest), found in cells.items():
        weight = [1 / (longest + 2) if k >= order - 1 - longest else 0.0 for k in range(order + 1)]
        for _ in range(50):
            new = [0.0] * (order + 1)
            for ratio, times in found.items():
                whole = sum(r * w for r, w in zip(ratio, weight))
                new = [a + times * r * w / whole for a, r, w in zip(new, ratio, weight)]
            weight = [x / sum(found.values()) for x in new]
        weights[group] = [0.999 * w + (0.0005 if k >= order - 1 else 0) for k, w in enumerate(weight)]

    def weight_of(group, longest):
        while group not in weights:
            if group == 0 or (group - 1) % 64 == 0:
                return [1 / (longest + 2) if k >= order - 1 - longest else 0.0 for k in range(order + 1)]
            group -= 1
        return weights[group]

    scores = []
    for i, words in texts:
        score = 0.0
        for out in grams(words):
            group, longest, parts = estimates(out, total, n, v)
            score += math.log10(sum(w * p for w, p in zip(weight_of(group, longest), [*parts, 1 / (v + 1)])))
        scores.append((i, len(words), round(score, 5)))
    return sorted(scores, key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model_equals_a_plain_mixture(documents, order):
    rows = [r for r in ODD if r[1] is None or len(r[1]) < 1000] + varied(120, seed=8)
    found = interpolated_lm.score_documents(documents(*rows).repartition(3), order)
    assert tuples(found.select("doc_id", "n_tokens", F.round("score", 5))) == mixture_by_hand(rows, order)


def test_language_model_base_and_gain(documents, no_documents):
    rows = ODD + varied(150, seed=6)
    found = {}
    for r in interpolated_lm.score_documents(documents(*rows)).collect():
        found.setdefault(r.doc_id, []).append(r)
    tokens = [(i, WORD.findall((t or "").translate(LOWER)) + ["\0end"]) for i, t in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    counts = Counter(w for i, own in tokens if i is not None and not held[i] for w in own)
    n, v = sum(counts.values()), len(counts)
    for i, own in tokens:
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        r = next(r for r in found[i] if r.n_tokens == len(own) and abs(r.base_score - base) < 1e-6 * (1 + abs(base)))
        assert (r.held_out, r.n_known, r.train_tokens) == (held[i], sum(w in counts for w in own), n)
        assert r.score <= 0 and math.isfinite(r.score)
    assert interpolated_lm.score_documents(no_documents).count() == 0


def test_language_model_beats_the_base_on_held_out_texts(spark):
    scored = interpolated_lm.score_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).where("held_out")
    base, own = scored.agg(F.sum("base_score"), F.sum("score")).first()
    assert own > 0.9 * base  # scores are negative


def test_mixture_weights_sum_to_one():
    weights = interpolated_lm.learned_weights([(3, 40, 8, 100), (3, -161, 8, 10), (5, -161, -161, 7)], 2)
    assert np.allclose(weights.sum(axis=1), 1) and (weights[:, 2] > 0).all() and weights[3, 0] > 0.5


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality_classifier.op10_quality_classifier(spark, sf)
    rows = scored.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)


def test_classifier_of_odd_texts_and_labels(documents, spark, no_documents):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 130)] + [(None, 1, 0), (101, None, 0), (102, 7, 0)], "doc_id long, quality int, toxic int")
    docs = documents(*ODD, *varied(40))
    model = quality_classifier.train(docs, labels)
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(docs, model).collect())
    nothing = quality_classifier.train(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.score(docs, nothing).collect()} == {0.5}
    good = quality_classifier.good(docs, model, threshold=0.0)
    assert good.schema == docs.schema and good.count() == docs.count()
    assert quality_classifier.score(no_documents, model).count() == 0


def exact(rows, every, k):
    real = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = []
    for q, own in real.items():
        if q % every == 0:
            scores = sorted((-float(np.sum(own * v)), i) for i, v in real.items() if i != q and len(v) == len(own))
            out += [(q, rank, i) for rank, (_, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(120)] + [(200 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]) for i in range(90)]
    rows += [(None, [1.0] * 8), (500, None), (520, []), (540, [0.0] * 8), (560, [None, *[1.0] * 7]), (580, [float("nan")] * 8), (600, [1.0, 2.0]), (620, [2.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).withColumn("rank", F.lit(1))
    found = neighbours.nearest(table, every=20, k=20, window=1.0)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found.collect()) == exact(rows, 20, 20)
    assert neighbours.nearest(table.limit(0), every=20).count() == 0


def test_neighbours_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = {(r.query_id, r.vec_id) for r in neighbours.op5_neighbours(spark, sf).collect()}
    wanted = {(q, i) for q, _, i in exact(rows, 20, 20)}
    assert len(found & wanted) >= 0.9 * len(wanted)


@pytest.mark.parametrize("spread", [0.0, 0.5])
def test_neighbours_recall_where_most_blocks_lie_outside_the_windows(spark, tmp_path, spread):
    rng = np.random.default_rng(7)
    n, every, k = 40_000, 100, 20
    vectors = rng.standard_normal((n, 64))
    vectors *= np.exp(spread * rng.standard_normal(n))[:, None] / np.linalg.norm(vectors, axis=1)[:, None]
    table = pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(vectors.ravel(), 64).cast(pa.list_(pa.float64()))})
    pq.write_table(table, tmp_path / "vectors.parquet")
    found = neighbours.nearest(spark.read.parquet(str(tmp_path / "vectors.parquet")), every, k).collect()
    scores = vectors[::every] @ vectors.T
    scores[np.arange(len(scores)), np.arange(0, n, every)] = -np.inf
    wanted = {(q * every, int(i)) for q, row in enumerate(np.argpartition(-scores, k, axis=1)[:, :k]) for i in row}
    recall = len(wanted & {(r.query_id, r.vec_id) for r in found}) / len(wanted)
    print(f"recall {recall:.4f} of {n} vectors, norms spread by {spread}")
    assert recall >= 0.9


def test_hilbert_steps_to_neighbouring_cells():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, places):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    wanted = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        wanted += [(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(p)[:5] for p in places), key=str) == sorted(wanted, key=str)
    bins = {}
    for p in places:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins), -(-sum(p.length for p in places) // 2048)


def test_packing_of_odd_texts(documents, no_documents):
    rows = ODD + varied(150)
    used, least = check_packing(rows, packing.pack_documents(documents(*rows), packing.default_tokenizer()).collect())
    assert used <= least + 1
    assert packing.pack_documents(no_documents, packing.default_tokenizer()).count() == 0


@pytest.mark.parametrize("length", [11, None, -1])
def test_pieces_that_fit_no_sequence_fail_the_job(spark, length):
    rows = spark.createDataFrame([(1, 0, 4), (2, 0, 10), (3, 0, length)], "doc_id long, piece int, length long")
    with pytest.raises(Exception, match="cannot be packed into sequences of 10 tokens"):
        packing.pack(rows, 10).collect()
    assert packing.pack(rows.where("doc_id < 3"), 10).count() == 2


def test_a_text_is_encoded_in_one_call(monkeypatch):
    from tokenizers import Tokenizer

    path, calls = packing.default_tokenizer(), []
    texts = ["", " a  b\n", "<|endoftext|> x<|endoftext|>", "".join(f" w{i}" for i in range(3000)), "it's 東京\u3000 \t1a"]
    units = packing.ByteUnits(path)

    class Counted:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(encoding, name)

    encoding = units.encoding
    monkeypatch.setattr(units, "encoding", Counted())
    got, plain = units.encode(texts), Tokenizer.from_file(path)
    assert [ids.tolist() for ids in got] == [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert len(calls) <= len(texts)


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 2048, 300).tolist()
    shard = packing.Shard(lengths, 2048, 1)
    a = shard.best_fit([], list(range(300)))
    b = shard.mutate(shard.mutate(a))
    for child in (shard.cross(a, b), shard.evolve([a, b], 10)):
        assert sorted(x for _, own in child for x in own) == list(range(300))
        assert all(free == 2048 - sum(lengths[x] for x in own) >= 0 for free, own in child)
    assert len(shard.evolve([a, b], 10)) <= len(a)
    assert (shard.numbers_of(shard.bins_of(shard.numbers_of(a))) >= 0).all()


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline
    from ratestrata.llm import quality_rules

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality_classifier.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = {r.doc_id for r in quality_classifier.score(docs, model).where("score >= 0.3").collect()}
    passed = {r.doc_id for r in quality_rules.ledger(docs).where("failures = 0").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good and r.doc_id in passed)
    rows = [row for row, (i, _, c) in zip(rows, components(rows, 5)) if i == c]
    rows = [(i, t if len(w) == len(k) else " ".join(k)) for (i, t), (_, w, k) in zip(rows, without_repeats(rows))]
    used, least = check_packing(rows, corpus_pipeline.run(spark, sf).collect())
    assert used <= least + 1


def test_stages_keep_the_columns_of_documents(documents, spark):
    import corpus_pipeline

    docs = documents(*ODD, *varied(30))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").schema == docs.schema, name


@pytest.mark.parametrize("kind", ["triples that fill sequences", "500 to 900"])
def test_the_evolution_needs_fewer_sequences_than_best_fit(spark, kind):
    rng = np.random.default_rng(3)
    if kind == "500 to 900":
        lengths = rng.integers(500, 901, 3000).tolist()
    else:
        firsts = rng.integers(500, 901, (700, 2))
        lengths = [*firsts.ravel().tolist(), *(2048 - firsts.sum(axis=1)).tolist()]
    shard = packing.Shard(sorted(lengths, reverse=True), 2048, 1)
    start = shard.best_fit([], list(range(len(lengths))))
    elite = [start]
    assert len(shard.evolve(elite, packing.GENERATIONS)) < len(start) and len(elite) == 1 and elite[0] is start
    rows = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    used = packing.pack(rows).select("sequence_id").distinct().count()
    assert -(-sum(lengths) // 2048) <= used < 0.98 * len(start)


def test_packings_of_any_start_hold_every_piece_once():
    rng = random.Random(9)
    for lengths in ([], [5], [2048, 2048], [0, 0, 7], [1] * 50, [rng.randrange(1, 2049) for _ in range(300)]):
        shard = packing.Shard(lengths, 2048, 2)
        for bins in (shard.fill(list(range(len(lengths)))), shard.fill(list(range(len(lengths))), 5), shard.evolve([], 4, 1)):
            assert sorted(i for _, own in bins for i in own) == list(range(len(lengths)))
            assert all(free >= 0 and free + sum(lengths[i] for i in own) == 2048 for free, own in bins)
