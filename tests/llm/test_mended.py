"""Bounds and links that odd rows once broke: repeated labelled ids, rows without ids between others, tied words."""

import re

import numpy as np
from pyspark.sql import functions as F

from quillmill.llm import decontaminate, hmm, near_text, pii, quality, secret_scan, sentencepieces, simhash, toxicity, warc, winnowing
from quillmill.llm.labelled import training_sample
from quillmill.llm.queries import op9_secrets

DATA = "/root/testdata/sf0.001"


def test_sample_is_bounded_where_ids_repeat(spark):
    many = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 2500).cast("string")).alias("text"))
    docs = many.union(spark.createDataFrame([(i, f"own {i}") for i in range(2, 40)], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)] + [(1, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = training_sample(docs, labels, "quality", 10).collect()
    assert len(got) == 10 == len({(r.text, r.y) for r in got})
    again = training_sample(docs.repartition(7), labels.repartition(3), "quality", 10).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert training_sample(docs, labels, "quality", 100_000).count() <= 2500 + 38


def test_quality_does_not_depend_on_partitions(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    models = [quality.fit(docs.repartition(n, "text"), labels.repartition(n, "doc_id")) for n in (3, 7)]
    assert models[0].cut == models[1].cut and np.array_equal(models[0].weights, models[1].weights) and models[0].slope == models[1].slope


def test_pairs_are_fitted_by_logistic_loss():
    """The pair fit against plain gradient steps on the same pairs."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] - 0.7 * x[:, 1] + rng.normal(size=400) * 0.5 > 0).astype(int)
    model = quality.fit_arrays(x, y, pairs=3000, seed=11)
    z = np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6), -6, 6)
    z = np.concatenate([z, np.abs(z)], axis=1)
    draw = np.random.default_rng(11)
    d = z[draw.choice(np.flatnonzero(y == 1), 3000)] - z[draw.choice(np.flatnonzero(y == 0), 3000)]
    w = np.zeros(d.shape[1])
    for _ in range(4000):
        w += 2e-3 * (d.T @ (1 / (1 + np.exp(d @ w))) - 20 * w) / 10
    assert np.allclose(w, model.weights, atol=1e-3)
    assert (z @ w > model.cut).mean() == float(np.mean(model.score(x) > quality.ACCEPTED)) and abs((model.score(x) > quality.ACCEPTED).mean() - y.mean()) < 0.02


def test_tied_words_fill_the_lexicon(spark):
    counts = spark.range(3000).select(F.concat(F.lit("w"), F.col("id").cast("string")).cast("binary").alias("word"), F.lit(2).cast("long").alias("c"))
    counts = counts.union(spark.createDataFrame([(hmm.END, 1), (b"often", 50)], "word binary, c long"))
    got = hmm.most_frequent(counts, 1000)
    assert 900 <= len(got) <= 1000 and got[0].word == b"often" and any(r.word == hmm.END for r in got)
    assert got == hmm.most_frequent(counts.repartition(5), 1000) and len(hmm.most_frequent(counts, 10_000)) == 3002 and [bytes(r.word) for r in hmm.most_frequent(counts, 1)] == [hmm.END]


def test_rows_without_ids_link_others(spark, monkeypatch):
    rows = [(1, 0), (None, 3), (2, 15), (None, 1 << 40), (None, 1 << 41), (7, 7 << 60), (None, (7 << 60) + 1), (9, 2**50 - 1)]
    fps = spark.createDataFrame(rows, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: fps)
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(fps).collect()}
    assert got == {(1, 0): 1, (None, 3): 1, (2, 15): 1, (None, 1 << 40): 1, (None, 1 << 41): 1, (7, 7 << 60): 7, (None, (7 << 60) + 1): 7, (9, 2**50 - 1): 9}
    alone = spark.createDataFrame([(None, 5), (None, 2**30)], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: alone)
    assert [r.component_id for r in simhash.near_duplicates(alone).collect()] == [None, None]


def plain_features(value, before, after, words):
    """The secret scan's features of a candidate, once more."""
    v = re.sub(secret_scan.ASSIGNED_INSIDE, "", value or "")
    before, after = re.sub(secret_scan.ASSIGNED, "", before or ""), after or ""
    n = max(len(v), 1)
    classes = re.sub("[+/_=-]", "-", re.sub("[0-9]", "0", re.sub("[A-Z]", "B", re.sub("[a-z]", "b", v))))
    lower = v.lower()
    rest = re.sub("|".join(sorted(words, key=lambda w: (-len(w), w))) or "$^", "", lower)
    near = dict.fromkeys(re.findall("[a-z]{4,}", f"{before} {after}".lower()))
    count = lambda kind: sum(bool(re.match(f"[{kind}]", c)) for c in v) / n
    found = lambda pattern, s: float(bool(re.search(pattern, s)))
    return [
        n, count("0-9"), count("A-Z"), count("a-z"), count("+/_=-"), (len(re.sub(r"(.)\1+", r"\1", classes)) - 1) / n, len(re.findall("[bB]0", classes)) / n, (len(set(v)) or 1) / n,
        max(map(len, re.findall("[A-Za-z]+", v)), default=0) / n, found("^[0-9a-f]+$", v), 1 - len(rest) / n, max(found(secret_scan.PATH_WORDS, before), found("/.*/", v)), found("^[\"'`]", after), found("=.", v),
        found("^[0-9-]+$", v), found("[a-z]{2,}[ ,.]+$", before), found("^[ ,.]+[a-z]{2,}", after), found(secret_scan.CODE_WORDS, before), found(secret_scan.CODE_WORDS, after),
        sum(w in set(words) for w in near) / max(1, len(near)), found(r"^\s*$|^[.]?\s*\n", after),
    ]


def walked(tree, x):
    at = 0
    while tree[at][0] >= 0:
        at = tree[at][2] if x[tree[at][0]] <= tree[at][1] else tree[at][3]
    return tree[at][4]


def test_secrets_again_in_plain_python(spark):
    """Features, forest, score and decision of every candidate of the query, and features of made-up ones."""
    data = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    words = secret_scan.dictionary(docs)
    found = secret_scan.find_candidates(docs)
    wanted = {(r.doc_id, r.start): plain_features(r.value, r.before, r.after, words) for r in found.collect()}
    x = {(r.doc_id, r.start): r.x for r in secret_scan.with_features(found, words).collect()}
    assert len(x) > 20 and x.keys() == wanted.keys()
    for k in x:
        assert np.allclose(x[k], wanted[k]), k
    made = [("token=aB3/aa//9xyz_-=", "the user config, ", '" in prose'), ("20240101-123456", "see https://x.com/path?", ".\n"), ("deadbeef00deadbeef", "api_key: ", ""), ("", "", ""), (None, None, None), ("AKIA" + words[0].upper() + "1234567", "  ", "` account"), ("thethethe123the", "word word, ", " and more")]
    for (value, before, after), r in zip(made, secret_scan.with_features(spark.createDataFrame(made, "value string, before string, after string").coalesce(1), words).collect()):
        assert np.allclose(r.x, plain_features(value, before, after, words)), value
    labels = {(r.doc_id, r.start): r.y for r in secret_scan.labelled_findings(found).collect()}
    for r in found.collect():
        mixed = bool(re.search("[A-Za-z]", r.value)) and bool(re.search("[0-9].*[0-9].*[0-9]", r.value))
        assert labels[r.doc_id, r.start] == int(bool(re.search(secret_scan.KNOWN_FORMATS, r.value)) or mixed and bool(re.search(secret_scan.ASSIGNED, r.before) or re.search(secret_scan.ASSIGNED_INSIDE, r.value)))
    trees = secret_scan.fit(secret_scan.taught_findings(docs, words).where("not judged"))
    for r in op9_secrets(spark, data).collect():
        score = sum(walked(t, x[r.doc_id, r.start]) for t in trees) / len(trees)
        assert abs(score - r.score) < 1e-9 and r.is_secret == (r.score >= 0.5)


def test_decoding_of_odd_rows(spark):
    processor = sentencepieces._processor(sentencepieces._model(sentencepieces.MODEL))
    ids = processor.encode("one  two é 日本 🎉")
    rows = [(1, ids, "x"), (1, ids, "x"), (None, ids, "x"), (2, None, "x"), (3, [], "x"), (4, ids * 3000, "x")]
    got = sentencepieces.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>, text string"))
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(str((i, processor.decode(x) if x else "")) for i, x, _ in rows)
    assert got.columns == ["doc_id", "text"] and sentencepieces.decode(spark.createDataFrame([], "doc_id long, ids array<int>")).count() == 0


def test_linking_of_odd_fingerprints(spark):
    links = lambda rows, **how: {tuple(sorted((r.a, r.b))) for r in simhash.link_fingerprints(spark.createDataFrame(rows, "fp long, rep long, node string"), **how).collect()}
    assert links([]) == set() and links([(5, 1, "x")]) == set()
    assert links([(0, 1, None), (3, 2, None), (-1, 3, None), (-4, 4, None), (1 << 40, 9, "a")]) == {(1, 2), (3, 4), (1, 9)}
    assert links([(0, 1, "x"), (7, 2, "x"), (1, 3, "x")], radius=1) == {(1, 3)}


def test_odd_tables_of_the_rest(spark):
    """Empty tables and clashing columns where no other test has them."""
    real, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    odd = spark.createDataFrame([(None, None, 1.0, "e", 3), (7, "", 1.0, "e", 3), (7, "", 1.0, "e", 3), (8, "mail me at a.b@c.de", 1.0, "e", 3)], "doc_id long, text string, score double, kind string, start int")
    personal, good, toxic = pii.fit(real), quality.fit(real, labels), toxicity.fit(real, labels)
    assert [r.text for r in pii.redact(odd, personal).orderBy("doc_id").collect()] == [None, "", "", "mail me at [EMAIL]"] and pii.redact(odd, personal).columns == odd.columns
    scored = quality.with_scores(odd, good)
    assert scored.count() == 4 and scored.columns == ["doc_id", "text", "kind", "start", "score"]
    empty = odd.limit(0)
    assert pii.redact(empty, personal).count() == quality.with_scores(empty, good).count() == toxicity.find_passages(empty, toxic).count() == winnowing.fingerprints(empty).count() == winnowing.edited_comparison(empty).count() == 0
    assert winnowing.fingerprints(odd).count() == 4 and winnowing.edited_comparison(odd).count() == 4 and toxicity.find_passages(odd, toxic).count() == 0
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontaminate.find_contamination(empty, items).count() == decontaminate.find_contamination(odd, items.limit(0)).count() == decontaminate.clean_documents(empty, items).count() == 0
    assert decontaminate.clean_documents(odd, items.limit(0)).count() == 4
    assert warc.read_archives(spark.createDataFrame([], "archive binary")).count() == 0
    assert warc.read_archives(spark.createDataFrame([(None, 1), (b"", 2)], "archive binary, page_id int")).count() == 0


def test_all_pairs_near_the_limit_in_large_groups(spark, monkeypatch):
    """Texts that share most shingles, so that their keys are parted into blocks; a quarter are pairs at 0.8 to 0.84, all others below."""
    monkeypatch.setattr(near_text, "LARGE_KEY", 200)
    rng, common, texts, pairs = np.random.default_rng(1), [f"c{i}" for i in range(150)], [], set()
    for i in range(0, 1200, 2):
        own = common + [f"t{i}w{j}" for j in range(60)]
        k = int(rng.integers(18, 23)) if i % 4 else 60
        other = own[:-k] + [f"u{i}w{j}" for j in range(k)]
        texts += [" ".join(own), " ".join(other)]
        if near_text.similarity(texts[-2].encode(), texts[-1].encode(), 5) >= 0.8:
            pairs.add((i, i + 1))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_text.near_duplicate_classes(docs).collect()}
    assert len(pairs) == 300 and {(c, i) for i, c in got.items() if c != i} == pairs
