"""The classifier and line dedup on small tables, and the pipeline."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from plain import groups, spark_docs

from burstguard.llm import line_dedup, pu


def sample(rng, n, good):
    """Two overlapping clouds."""
    return rng.normal(1.5 if good else -1.5, 1.0, (n, pu.FEATURES))


def test_risk_and_prior():
    rng = np.random.default_rng(1)
    mixed = np.vstack([sample(rng, 1400, True), sample(rng, 600, False)])
    rng.shuffle(mixed)
    model = pu.fit(sample(rng, 1000, True), pu.Matrix(mixed))
    assert abs(model.prior - 0.7) < 0.08
    assert (model.score(sample(rng, 500, True)) >= pu.THRESHOLD).mean() > 0.95
    assert (model.score(sample(rng, 500, False)) >= pu.THRESHOLD).mean() < 0.05
    assert pu.fit(sample(rng, 10, True), pu.Matrix(np.zeros((0, pu.FEATURES)))) is None


def test_steps_follow_the_risk():
    """The gradient is that of the risk, and where the bad texts' part of it is negative, against that part."""
    rng = np.random.default_rng(2)
    good, mixed = sample(rng, 60, True), np.vstack([sample(rng, 50, True), sample(rng, 50, False)])
    model = pu.Model(mixed.mean(axis=0), mixed.std(axis=0), np.zeros(0), 0.5)
    p, u = model.inputs(good), model.inputs(mixed)

    def bad(w, prior):
        return np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()

    def whole(w, prior):
        return prior * np.logaddexp(0, -(p @ w)).mean() + bad(w, prior)

    for prior in (0.3, 0.9):
        step = pu.risk(model, good, pu.Matrix(mixed), prior)
        for w in (np.zeros(p.shape[1]), rng.normal(0, 0.05, p.shape[1]), rng.normal(0, 0.5, p.shape[1])):
            g, h, turned = step(w)
            assert turned == (bad(w, prior) < 0)
            f = (lambda x: -bad(x, prior)) if turned else (lambda x: whole(x, prior))
            for i in (0, 7, p.shape[1] - 1):
                e = np.zeros(p.shape[1])
                e[i] = 1e-5
                assert g[i] == pytest.approx((f(w + e) - f(w - e)) / 2e-5, abs=1e-6)
            assert np.linalg.eigvalsh(h).min() > -1e-9


def test_all_rows_are_learned_from(corpus_spark):
    """Sums over blocks in Spark are those over one matrix; a repeated id gives one row to the good sample."""
    docs = spark_docs(corpus_spark).repartition(5)
    labels = corpus_spark.createDataFrame([(i, 1, 0) for i in range(24)], "doc_id long, quality int, toxic int")
    model = pu.train(docs, labels)
    rows = [r for r in docs.filter(~pu.held_out(docs["doc_id"]) & docs["doc_id"].isNotNull()).collect()]
    mixed = np.array([pu.features(r["text"] or "") for r in rows])
    by_id = {}
    for r, x in zip(rows, mixed.tolist()):
        if r["doc_id"] < 24:
            by_id[r["doc_id"]] = min(x, by_id.get(r["doc_id"], x))
    plain = pu.fit(np.array([by_id[i] for i in sorted(by_id)]), pu.Matrix(mixed))
    assert np.allclose(model.mean, plain.mean) and np.allclose(model.weights, plain.weights, atol=0.05)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the test tables")
def test_held_out_labels(corpus_spark):
    from burstguard.llm.queries import QUERIES

    scored = QUERIES["op3_pu_quality"](corpus_spark, "/root/testdata/sf0.01")
    labels = corpus_spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").select("score", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert len(good) > 50 and len(bad) > 10 and auc > 0.9


def test_classify(corpus_spark):
    docs = spark_docs(corpus_spark)
    labels = corpus_spark.createDataFrame([(i, 1, 0) for i in range(24)], "doc_id long, quality int, toxic int")
    model = pu.train(docs, labels)
    got = pu.classify(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert pu.train(docs, labels.limit(0)) is None
    assert {r["score"] for r in pu.classify(docs, None).collect()} == {0.5}
    assert pu.classify(docs.limit(0), model).count() == 0


def jaccard(a, b):
    a, b = ({x[i : i + 5] for i in range(len(x) - 4)} or {x} for x in (a.strip().lower(), b.strip().lower()))
    return len(a & b) / len(a | b)


def test_lines(corpus_spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    lines = [line(rng.randint(8, 40)) for _ in range(40)]
    near = []
    for x in lines[:20]:
        parts = x.split()
        parts[rng.randrange(len(parts))] = rng.choice(words)
        near.append(" ".join(parts))
    pool = lines + near + lines[:5] + ["", "  ", "x", "yy", lines[0].upper(), "漢字かな交じり文の長い行" * 3, "漢字かな交じり文の長い行" * 3 + "。"]
    rng.shuffle(pool)
    rows = [(i, "\n".join(pool[3 * i : 3 * i + 3]), None, None, 0) for i in range(-(-len(pool) // 3))]
    rows += [rows[1], rows[1], (None, rows[2][1], None, None, 0), (500, None, None, None, None), (501, "", None, None, 0)]
    got = line_dedup.dedup_lines(spark_docs(corpus_spark, rows)).collect()
    different = sorted({x for r in rows for x in (r[1] or "").split("\n") if x.strip()})
    links = [(i, j) for i in range(len(different)) for j in range(i) if jaccard(different[i], different[j]) >= 0.8]
    root = dict(zip(different, groups(len(different), links)))
    kept = [x for r in got if r["text"] for x in r["text"].split("\n") if x.strip()]
    assert Counter(root[x] for x in kept) == Counter(set(root.values()))  # one of each component
    assert sum(r["n_lines"] for r in got) == sum(1 for r in rows for x in (r[1] or "").split("\n") if x.strip())
    assert sum(r["n_lines"] - r["n_dropped"] for r in got) == len(kept)
    blanks = sum(1 for r in rows if r[1] for x in r[1].split("\n") if not x.strip())
    assert sum(1 for r in got if r["text"] and r["n_lines"] for x in r["text"].split("\n") if not x.strip()) <= blanks
    assert next(r for r in got if r["doc_id"] == 500)["text"] is None
    assert line_dedup.dedup_lines(spark_docs(corpus_spark).limit(0)).count() == 0


def test_bands_of_many_lines(corpus_spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BAND_ROWS", 10)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 5)
    base = "this line is found with small changes in every document of the whole table and is long enough for it "
    rows = [(i, base + str(i), None, None, 0) for i in range(60)]
    got = line_dedup.dedup_lines(spark_docs(corpus_spark, rows)).collect()
    assert sorted(r["doc_id"] for r in got if r["text"]) == [0]


def check_lines(spark, lines):
    """What stays is one line of each component that brute force finds."""
    rows = [(i, "\n".join(lines[3 * i : 3 * i + 3]), None, None, 0) for i in range(-(-len(lines) // 3))]
    got = line_dedup.dedup_lines(spark_docs(spark, rows)).collect()
    different = sorted(set(lines))
    runs = [{y[i : i + 5] for i in range(len(y) - 4)} or {y} for y in (x.strip().lower() for x in different)]
    links = [
        (i, j) for i in range(len(runs)) for j in range(i) if len(runs[i] & runs[j]) >= 0.8 * len(runs[i] | runs[j])
    ]
    root = dict(zip(different, groups(len(different), links)))
    kept = Counter(root[x] for r in got if r["text"] for x in r["text"].split("\n"))
    assert kept == Counter(set(root.values()))
    return len(different) - len(kept)


def test_near_copies_of_lines_without_blanks(corpus_spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    lines = ["https://" + "/".join(word(9) for _ in range(8)) for _ in range(20)]
    lines += ["\t".join(word(6) for _ in range(14)) for _ in range(20)]
    lines += [" ".join(word(20) for _ in range(3)) for _ in range(20)]
    lines += ["".join(rng.choice("ကခဂဃငစဆဇဈညဋဌဍဎဏတထဒဓနပဖဗဘမယရလဝသဟဠအ") for _ in range(70)) for _ in range(20)]
    typo = lambda x, at: x[:at] + ("#" if at < len(x) else "") + x[at + 1 :]
    lines += [typo(x, rng.choice([len(x) // 2, len(x) - 1])) for x in lines]
    assert check_lines(corpus_spark, lines) == 80


def test_hot_bands_of_many_small_groups(corpus_spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    head, lines = " ".join(word() for _ in range(22)), []
    for _ in range(160):
        own = [word() for _ in range(6)]
        lines += [f"{head} {' '.join(own)}", f"{head} {' '.join(own[:-1])} {word()[:2]}"]
    rng.shuffle(lines)
    assert check_lines(corpus_spark, lines) == 160


def test_pipeline_stages(corpus_spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    text = lambda n: ". ".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(n))
    passage = text(12)
    clean = [text(10) for _ in range(30)]
    texts = clean + [clean[0]] * 5 + [clean[1] + " more", "short", "!!! $$$ " * 40, passage + text(9), text(9) + passage, None]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    corpus_spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    docs, seen = corpus_spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = f"{tmp_path}/{name.replace(' ', '-')}"
        stage(corpus_spark, docs, str(tmp_path)).write.parquet(out)
        docs = corpus_spark.read.parquet(out)
        seen.append(docs.collect())
    quality, lines, near, passages, pieces = seen
    assert {r["doc_id"] for r in quality} == set(range(len(texts))) - {36, 37, 40}
    by_id = {r["doc_id"]: r["text"] for r in lines}
    assert [by_id[i] for i in range(2, 30)] == clean[2:] and sum(bool(by_id[i]) for i in (0, 30, 31, 32, 33, 34)) == 1
    assert len([r for r in near if r["doc_id"] in (0, 30, 31, 32, 33, 34)]) <= 2
    assert all(r["n_chars"] == len(r["text"]) for r in passages)
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in passages}
    again = corpus_pipeline.run(corpus_spark, str(tmp_path))
    assert sum(r["length"] for r in again.collect()) == sum(r["length"] for r in pieces)


def test_signatures_do_not_depend_on_the_way(corpus_spark, monkeypatch):
    """A line's hashes are compared with the points of their own part, or with all: the values are the same."""
    rng = random.Random(12)
    lines = [" ".join(str(rng.randint(0, 999)) for _ in range(n)) for n in (1, 3, 12, 14, 30, 50, 80, 200, 400)]
    lines += ["-" * n for n in (5, 50, 170, 900)]
    frame = corpus_spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    rows = lambda: sorted(line_dedup.signatures(frame).drop("unlike").collect())
    parted = rows()
    assert len(parted) == len(lines) and len({tuple(r["bands"]) for r in parted[-4:]}) == 1
    monkeypatch.setattr(line_dedup, "PARTS", [(10**9, 4)])
    assert rows() == parted


def test_similar_lines_share_a_band(corpus_spark):
    """Of pairs just above the border hardly any lacks a common band or has too different a sketch; of others most do."""
    rng = random.Random(13)
    line = lambda n: " ".join(str(rng.randint(0, 9999)) for _ in range(n))
    pairs = []
    for n in (10, 20, 40, 80, 160):
        while len(pairs) < 100 * [10, 20, 40, 80, 160].index(n) + 100:
            parts = line(n).split()
            changed = list(parts)
            for _ in range(rng.randint(1, max(1, n // 12))):
                changed[rng.randrange(n)] = str(rng.randint(0, 9999))
            a, b = " ".join(parts), " ".join(changed)
            if 0.8 <= jaccard(a, b) < 0.85:
                pairs.append((a, b))
    lines = [x for p in pairs for x in p]
    frame = corpus_spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    by_id = {r["line_id"]: r for r in line_dedup.signatures(frame).collect()}

    def differ(a, b):
        bits = [(a[c] ^ b[c]) % (1 << 64) for c in ("bits", "more_bits")]
        return sum(((x | x >> 1) & 0x5555555555555555).bit_count() for x in bits)

    def met(a, b):
        return bool(set(a["bands"]) & set(b["bands"])) and differ(a, b) <= max(a["unlike"], b["unlike"])

    assert sum(met(by_id[2 * i], by_id[2 * i + 1]) for i in range(len(pairs))) >= 0.99 * len(pairs)
    assert sum(met(by_id[2 * i], by_id[2 * i + 2]) for i in range(len(pairs) - 1)) <= 2


def test_bands_of_one_label_are_passed_over(corpus_spark, tmp_path):
    """What earlier bands have linked is not moved again, and a band of two lines is a pair."""
    rows = [(1, 1, 7), (2, 1, 7), (3, 1, 7), (4, 4, 8), (5, 5, 8), (6, 6, 9), (7, 6, 9), (8, 8, 9), (9, 9, 10)]
    frame = corpus_spark.createDataFrame(rows, "line_id long, label long, band long")
    shared, members = line_dedup.held(frame.selectExpr("*", "true as other"))
    assert sorted((r["band"], r["n"], r["low"], r["high"]) for r in shared.collect()) == [(8, 2, 4, 5), (9, 3, 6, 8)]
    assert sorted((r["line_id"], r["low"], r["low_label"]) for r in members.collect()) == [(6, 6, 6), (7, 6, 6), (8, 6, 6)]


def test_unlike_lines_seldom_share_a_band(corpus_spark):
    rng = random.Random(14)
    word = lambda: str(rng.randint(0, 9999))
    lines = []
    while len(lines) < 600:
        parts = [word() for _ in range(60)]
        changed = [x if rng.random() < 0.75 else word() for x in parts]
        if 0.3 <= jaccard(" ".join(parts), " ".join(changed)) < 0.45:
            lines += [" ".join(parts), " ".join(changed)]
    frame = corpus_spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    bands = {r["line_id"]: set(r["bands"]) for r in line_dedup.signatures(frame).collect()}
    assert sum(bool(bands[2 * i] & bands[2 * i + 1]) for i in range(300)) <= 30


def test_bands_are_read_one_by_one(corpus_spark):
    """Signatures are wide: a table of labelled bands reads the columns of its own bands only."""
    lines = corpus_spark.range(40).selectExpr("id as line_id", "concat('some words stand here ', repeat(id, 30)) as line")
    signed = line_dedup.signatures(lines)
    labels = corpus_spark.range(5).selectExpr("id as line_id", "0L as label")
    rows = line_dedup.bands_of(line_dedup.labelled(signed, labels), 2, 5)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [x.split("Batched")[0] for x in plan.split("\n") if "FileScan parquet" in x]
    assert scans and all("band3#" in x and "band1#" not in x and "bands#" not in x and "least#" not in x for x in scans)
    want = {(r["line_id"], i, r["bands"][i]) for r in signed.collect() for i in (2, 3, 4)}
    assert {(r["line_id"], r["number"], r["band"]) for r in rows.collect()} == want


def test_links_are_exact_from_counts_taken_once(corpus_spark):
    rng = random.Random(8)
    texts = ["", "a", "ab", "abcd", "abcde", "abcdef", "aaaaaaaaaa", "aaaaa", "é漢\U0001f600xyz", "é漢\U0001f600xyz!"]
    for _ in range(12):
        base = "".join(rng.choice("abc ") for _ in range(rng.randint(20, 60)))
        texts += [base, base + "x", base[1:], base[:-2] + "zz", base + base]
    lines = corpus_spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "line_id long, line string")
    every = [(i, j) for i in range(len(texts)) for j in range(i)]
    counted = line_dedup.texts_of(lines, lines.select("line_id"))
    pieces = lambda t: {t[i : i + 5] for i in range(max(1, len(t) - 4))}
    assert {r["line_id"]: r["n"] for r in counted.collect()} == {i: len(pieces(t)) for i, t in enumerate(texts)}
    found = line_dedup.links(counted, corpus_spark.createDataFrame(every, "a long, b long")).collect()
    assert {tuple(r) for r in found} == {(i, j) for i, j in every if jaccard(texts[i], texts[j]) >= 0.8}
