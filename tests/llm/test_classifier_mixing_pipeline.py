"""Classifier on held-out labels, mixing against plain Python, and the pipeline stage by stage."""

import hashlib
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
from lakehand.llm import mixing, quality_classifier
from lakehand.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    rows = QUERIES["op1_quality_classifier"](spark, SF).toPandas().set_index("doc_id")
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in rows.held_out.items())
    assert (rows.predicted == (rows.score >= 0.3)).all() and rows.score.between(0, 1).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    both = rows[rows.held_out].join(labels, how="inner").dropna()
    assert len(both) > 20 and (both.predicted == both.quality).mean() >= 0.9


def test_normal_equations_equal_one_solve(spark):
    """Sums over partitions and folds against numpy's least squares with the ridge as extra rows."""
    import random
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices(["good", "text", "###", "of", "words,", "A1"], k=rng.randint(1, 80)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = {i: float("###" not in t) for i, t in rows}
    stats = quality_classifier.document_stats(docs)
    model = quality_classifier.fit(stats, spark.createDataFrame(list(labels.items()), "doc_id long, label double"))
    table = stats.toPandas().set_index("doc_id").sort_index()
    train = [i for i in table.index if zlib.crc32(str(i).encode()) % 5]
    x = table.to_numpy()
    z = quality_classifier.fourier(table.loc[train].to_numpy(), x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6))
    extra = np.sqrt(quality_classifier.RIDGE * len(train) / quality_classifier.FEATURES) * np.eye(z.shape[1])
    expected, *_ = np.linalg.lstsq(np.vstack([z, extra]), np.append([labels[i] for i in train], np.zeros(len(extra))), rcond=None)
    assert np.allclose(model.weights, expected, atol=1e-6)


def test_isotonic_equals_brute_force():
    """Pooled values against the largest of least averages (the min-max formula)."""
    rng = np.random.default_rng(4)
    y, n = rng.integers(0, 9, 30).astype(float), rng.integers(9, 20, 30).astype(float)
    at, value = quality_classifier.isotonic(np.arange(30.0), y, n)
    mean = lambda a, b: y[a:b].sum() / n[a:b].sum()
    exact = np.array([max(min(mean(a, b) for b in range(i + 1, 31)) for a in range(i + 1)) for i in range(30)])
    assert np.allclose(sorted(set(np.round(exact, 9))), np.round(value, 9))


def test_isotonic_blocks_rise():
    at, value = quality_classifier.isotonic(np.arange(6.0), np.array([0, 3, 1, 4, 2, 5.0]), np.full(6, 5.0))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all() and abs(value[-1] - 1) < 1e-9


def test_classifier_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (5, 0), (7, 1), (None, 1), (4, None), (99, 1), (5, 0)], "doc_id long, quality int")
    for given in (labels, labels.limit(0)):
        got = quality_classifier.quality(odd_docs, given).collect()
        assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
        assert quality_classifier.quality(no_docs, given).count() == 0


def shared(children, total):
    """Budget by weight with limits: fill the tightest child first."""
    out, left, w = {}, total, sum(c[1] for c in children)
    for key, weight, cap in sorted(children, key=lambda c: (c[2] / c[1], c[0])):
        if cap * w <= left * weight:
            out[key] = cap
            left, w = left - cap, w - weight
        else:
            out[key] = left * weight // w
    return out


def brute_mix(docs, epochs, percent):
    """copies per doc_id, level by level and epoch by epoch."""
    def domain(source):
        n = int(source[3:] or 0)
        return "web" if n % 6 < 3 else "books" if n % 6 < 5 else "code"
    leaves = defaultdict(list)
    for i, text, lang, source in docs:
        leaves[(domain(source), lang, source)].append((i, len(text.split())))
    cap = {leaf: epochs * sum(n for _, n in own) for leaf, own in leaves.items()}
    budget = {(): sum(cap.values()) // epochs * percent // 100}
    for depth, weights in enumerate((mixing.DOMAIN_WEIGHTS, mixing.LANGUAGE_WEIGHTS, mixing.SOURCE_WEIGHTS)):
        below = {}
        for node, total in budget.items():
            kids = defaultdict(int)
            for leaf, c in cap.items():
                if leaf[:depth] == node:
                    kids[leaf[:depth + 1]] += c
            below |= shared([(k, weights.get(k[-1], 1), c) for k, c in kids.items()], total)
        budget = below
    copies = {}
    for leaf, own in leaves.items():
        tokens = sum(n for _, n in own)
        full, rest = divmod(budget[leaf], tokens)
        order = sorted(own, key=lambda d: hashlib.md5(f"{mixing.SEED}:{full}:{d[0]}".encode()).hexdigest())
        used, taking = 0, True
        for i, n in order:
            taking = taking and used + n <= rest
            used += n
            copies[i] = full + taking
    return copies


def test_mixing_is_the_brute_force_one(make_docs):
    rng = np.random.default_rng(5)
    langs, sources = ["en", "de", "fr", "es", "xx"], [f"src{i}" for i in range(7)]
    docs = [(i, " ".join(["w"] * int(rng.integers(1, 60))), langs[int(rng.integers(5) * rng.random())],
             sources[int(rng.integers(7) * rng.random())]) for i in range(400)]
    for epochs, percent in ((2, 80), (3, 150), (1, 30)):
        got = mixing.selection(make_docs(docs), epochs, percent).collect()
        assert {r.doc_id: r.copies for r in got} == brute_mix(docs, epochs, percent)
        rows = mixing.mixed(make_docs(docs, extra=True), epochs, percent).groupBy("doc_id").count().collect()
        assert {r.doc_id: r["count"] for r in rows} == {i: c for i, c in brute_mix(docs, epochs, percent).items() if c}


def test_mixing_odd_rows(odd_docs, no_docs):
    assert mixing.selection(odd_docs).count() == odd_docs.count()
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    assert mixing.selection(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_stages_keep_columns_and_extra_ones(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_pipeline_drops_copies_and_junk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    unique = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).select("doc_id").collect()}
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        if (r.text or "").split():
            texts[r.text].append(r.doc_id)
    assert all(sum(i in unique for i in ids) <= 1 for ids in texts.values())
