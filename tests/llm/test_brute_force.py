"""Each operator against a plain version on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillmill.llm import components, decontaminate, hmm, near_text, pii, sentencepieces, simhash, toxicity, warc, winnowing
from quillmill.llm.support import SPACES, Groups, byte_class, hashed_words

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


def plain_components(ids, linked):
    groups = Groups()
    for i in ids:
        groups.root(i)
    for a, b in linked:
        groups.join(a, b)
    return {i: groups.root(i) for i in ids}


def plain_simhash(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, docs, rows):
    fps = {i: plain_simhash(t) for i, t in rows}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    wanted = plain_components(fps, links)
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (fps[i], wanted[i]) for i in fps}


@pytest.mark.parametrize("hot", [2048, 3])
def test_links_of_clustered_fingerprints(spark, monkeypatch, hot):
    """Groups within a few bits of each other, with keys compared and with keys linked by flipped bits."""
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    rng = np.random.default_rng(3)
    fps = set()
    for base in rng.integers(0, 2**63, 5).tolist():
        fps |= {base ^ int(np.bitwise_or.reduce(1 << rng.integers(0, 63, n).astype(np.int64))) for n in rng.integers(1, 4, 40)}
    fps = dict(enumerate(sorted(fps)))
    wanted = plain_components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    links = simhash.link_fingerprints(spark.createDataFrame([(f, r) for r, f in fps.items()], "fp long, rep long"), 2)
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    assert {i: roots.get(i, i) for i in fps} == wanted


@pytest.mark.parametrize("radius,segments", [(2, 7), (2, 5), (3, 7), (1, 3)])
def test_every_near_pair_has_a_chain(radius, segments):
    ring, rng = simhash.Ring(radius, segments), np.random.default_rng(radius)
    for _ in range(200):
        a = rng.integers(0, 2**63, 1, dtype=np.uint64)
        b = a ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, radius, replace=False).astype(np.uint64), keepdims=True)
        keys = [s for s in range(segments) if not (simhash.rotated(a ^ b, ring.starts[s]) & np.uint64((1 << ring.width(s, ring.equal)) - 1))[0]]
        assert any(len(simhash.within_chains(a, b, s, ring)) for s in keys)


@pytest.mark.parametrize("radius,segments,hot", [(3, 7, 2048), (3, 7, 4), (2, 7, 4), (1, 3, 4)])
def test_links_at_other_radii(spark, monkeypatch, radius, segments, hot):
    monkeypatch.setattr(simhash, "HOT_KEY", hot)
    rng = np.random.default_rng(radius)
    fps = set()
    for base in rng.integers(0, 2**63, 4).tolist():
        fps |= {base ^ int(np.bitwise_or.reduce(1 << rng.integers(0, 63, n).astype(np.int64))) for n in rng.integers(1, 6, 30)}
    fps = dict(enumerate(sorted(fps)))
    wanted = plain_components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= radius])
    links = simhash.link_fingerprints(spark.createDataFrame([(f, r) for r, f in fps.items()], "fp long, rep long"), radius, segments)
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    assert {i: roots.get(i, i) for i in fps} == wanted


def test_components_with_heavy_nodes(spark, monkeypatch):
    monkeypatch.setattr(components, "LIGHT", 5)
    monkeypatch.setattr(components, "MOST_HEAVY", 4)
    links = [(7, i) for i in range(100, 160)] + [(500, i) for i in range(300, 340)] + [(500, 100), (900, 901)] + [(1000, i) for i in range(600, 640)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = plain_components({i for x in links for i in x}, links)
    assert got == {i: r for i, r in wanted.items() if i != r}


def test_block_pairs_meet(spark):
    from quillmill.llm.support import in_block_pairs, in_blocks

    rows = spark.createDataFrame([(1, i) for i in range(100)] + [(2, i) for i in range(5)], "key long, rep long")
    met = defaultdict(set)
    for r in in_block_pairs(rows, "key", "rep", 20).collect():
        met[r.key].add(r.rep)
    assert met[2] == set(range(5)) and max(map(len, met.values())) < 80
    assert all(any({a, b} <= x for k, x in met.items() if k != 2) for a in range(100) for b in range(a))
    dealt = in_blocks(rows, "key", "rep", 20, 1).groupBy("key").count().collect()
    assert len(dealt) == 6 and sum(r["count"] for r in dealt) == 105


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(1, 60)] + [(100, 103), (103, 101), (7, 7), (None, 4)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(2, 61)} | {101: 100, 103: 100}


def shingles(text, k=5):
    words = text.encode().lower().split()
    if len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def test_near_text_classes(spark, docs, rows):
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    wanted = plain_components(sets, links)
    got = {r.doc_id: r.component_id for r in near_text.near_duplicate_classes(docs).collect()}
    assert got == wanted and len(set(wanted.values())) < len(wanted)
    kept = {r.doc_id for r in near_text.drop_near_duplicates(docs).collect()}
    assert kept == set(wanted.values())


def test_near_text_large_group(spark, monkeypatch):
    """A group of copies with small edits, larger than the keys of which all pairs are taken."""
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)]
    for i in range(60):
        own = list(base)
        own[int(rng.integers(0, 150))] = f"x{i}"
        texts.append(" ".join(own))
    texts += [" ".join(rng.permutation(base)) for _ in range(5)]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in near_text.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(61)} == {0} and all(got[i] == i for i in range(61, 66))
    monkeypatch.setattr(near_text, "LARGE_KEY", 20)  # several blocks of a key
    got = {r.doc_id: r.component_id for r in near_text.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(61)} == {0} and all(got[i] == i for i in range(61, 66))


@pytest.mark.parametrize("large_key", [4096, 20])
def test_near_text_large_group_at_the_limit(spark, monkeypatch, large_key):
    """Many texts share keys, and their pairs lie on both sides of 0.8: none of the links may be lost."""
    monkeypatch.setattr(near_text, "LARGE_KEY", large_key)
    rng = np.random.default_rng(7)
    texts, base = [], [f"w{i}" for i in range(200)]
    for i in range(90):
        own = list(base)
        for at in rng.choice(200, int(rng.integers(1, 8)), replace=False):
            own[at] = f"x{i}y{at}"
        texts.append(" ".join(own))
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    wanted = plain_components(sets, links)
    assert len(set(wanted.values())) > 5 and len(links) > 50
    got = {r.doc_id: r.component_id for r in near_text.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == wanted


def plain_winnow(text, k, w):
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    h = winnowing.gram_hashes(codes, min(k, len(codes))).tolist() if len(codes) else []
    if len(codes) < k:
        return [(x, 0) for x in h]
    kept = set()
    for i in range(max(1, len(h) - w + 1)):
        window = h[i : i + w]
        kept.add(i + max(j for j, x in enumerate(window) if x == min(window)))
    return [(h[i], i) for i in sorted(kept)]


@pytest.mark.parametrize("text", ["", "a", "abcde" * 3, "x" * 200, "the quick brown fox " * 9 + "été 🙂 " * 12, "".join(chr(97 + i * i % 26) for i in range(500))])
def test_winnowing(text, monkeypatch):
    for block in (1 << 22, 37):
        monkeypatch.setattr(winnowing, "_BLOCK", block)
        for k, w in ((16, 32), (5, 4), (3, 1)):
            h, p = winnowing.winnow(text, k, w)
            assert list(zip(h.tolist(), p.tolist())) == plain_winnow(text, k, w)


def test_gram_hashes_depend_on_the_gram_alone():
    a, b = ("xx" + "needle in haystack" + "yyy"), "needle in haystack"
    h = lambda s: winnowing.gram_hashes(np.frombuffer(s.encode("utf-32-le"), np.uint32), 7)
    assert h(a)[2:14].tolist() == h(b).tolist()
    shared = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(20))
    x, y = winnowing.winnow("before " + shared, 16, 8)[0], winnowing.winnow(shared + " after that", 16, 8)[0]
    assert set(x.tolist()) & set(y.tolist())


def test_edited_comparison(spark, docs, rows):
    got = {r.doc_id: r for r in winnowing.edited_comparison(docs).collect()}
    for n, (i, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (winnowing.winnow(x) for x in (text, edited, after))
        assert tuple(got[i]) == (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), winnowing.digest(*a), winnowing.digest(*b), winnowing.likeness(a[0], b[0]), winnowing.likeness(a[0], c[0]))
    assert len(got) == len(rows)


def plain_pii(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_base(rows):
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list("ab1234567890.@+- ()%_é"), 120)) for _ in range(1500)]
    made += ["a@b@c.de.f x@y", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.4", "4111 1111 1111 1111-4111", "+1 (578) 555-6437 4918187128635271", "q@.x a@b-c.d", "\n+12345678\n9 0"]
    for text in made + [t for _, t in rows]:
        assert pii.base_spans(text) == plain_pii(text), text


def test_pii_added_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.fit(docs)
    assert all(precision > 0.95 and recall > 0.8 and n > 30 for precision, recall, n in model.measured.values())
    text = "Call +1 (578) 555-6437 4918187128635271 now"
    base, spans = model.spans(text)
    assert base == [] and ("card", 23, 39) in spans
    assert pii.redacted(text, spans).endswith("[CARD] now")
    base, spans = model.spans("mail ab.1@mail5.example.com, ip 10.2.3.4")
    assert base == spans == [("email", 5, 27), ("ip", 32, 40)]
    base, spans = model.spans("see ab.1 [at] mail5 [dot] example [dot] com please")
    assert base == [] and spans == [("email", 4, 43)]


def test_pii_query(spark, docs, rows):
    """Counts, hash and spans of every document; what is added touches nothing of the base."""
    from quillmill.llm.queries import op5_pii

    for r in op5_pii(spark, DATA).collect():
        text = dict(rows)[r.doc_id]
        wanted = pii.named(plain_pii(text))
        kinds = Counter(k for k, _, _ in plain_pii(text))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(wanted.encode()).hexdigest() and set(filter(None, wanted.split(","))) <= set(r.spans.split(","))


def test_warc_round_trip(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html")
    big = "é" * 700
    more = spark.createDataFrame([(900, "u", big), (901, None, big), (902, "u", big), (902, "u", big), (903, "u", "small"), (904, "u", "small"), (905, "u", None), (None, "u", big)], "page_id long, url string, html string")
    rows = pages.union(more)
    back = warc.read_archives(warc.write_archives(rows)).collect()
    assert len(back) == rows.count()
    html = {r.page_id: (r.html or "").encode() for r in rows.collect()}
    for r in back:
        assert r.payload_bytes == len(html[r.page_id]) and r.payload_digest == hashlib.sha1(html[r.page_id]).hexdigest()
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[r.page_id]
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in back if r.page_id is None or r.page_id >= 900) == [(0, "response", None), (900, "revisit", 902), (901, "revisit", 902), (902, "response", None), (902, "response", None), (903, "response", None), (904, "response", None), (905, "response", None)]


def test_warc_frames(tmp_path, spark):
    import zstandard

    records = [warc.record(i, f"http://x/{i}", (f"<p>page {i}</p>" * 40).encode(), "d", 1, None, "2020-01-01T00:00:00Z") for i in range(60)]
    data = warc.archive(records)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
    assert first.decompress(data[8 + size :]) == records[0] and first.unused_data
    assert len(list(warc.read_records(data))) == 60
    df = spark.createDataFrame([(bytearray(data),)], "archive binary")
    assert warc.export_archives(df, str(tmp_path)) == 1 and (tmp_path / "part-00000.warc.zst").read_bytes() == data


def test_every_archive_has_a_dictionary(spark):
    """Small, few, large and equal records; without pages there is no archive."""
    rng = np.random.default_rng(1)
    large = [rng.integers(32, 120, 1_000_000).astype(np.uint8).tobytes() + b"<p>the same end</p>" * 2000 for _ in range(14)]
    for records in ([b"WARC/1.1 one small record"], [b"x" * 50] * 3, [b"same"] * 4000, large, [bytes([i % 251]) * 300 for i in range(500)]):
        data = warc.archive(records)
        assert int.from_bytes(data[4:8], "little") > 0 and data[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert len(warc.build_dictionary(large)) > 1000
    pages = spark.createDataFrame([(i, "u", x.decode("latin-1"), "extra") for i, x in enumerate(large[:3])] + [(9, "u", "", None)], "page_id long, url string, html string, digest string")
    back = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.round_trip(pages).collect()}
    assert back == {i: (len(x.decode("latin-1").encode()), "response") for i, x in enumerate(large[:3])} | {9: (0, "response")}
    assert warc.round_trip(pages.limit(0)).count() == 0
    clash = pages.selectExpr("page_id", "url", "html", "'a' as size", "1 as kept", "2 as n", "3 as refers_to")
    assert warc.round_trip(clash).count() == 4


def test_maximal_segments():
    """Ruzzo and Tompa's segments, by their recursive definition."""
    rng = np.random.default_rng(4)

    def plain(scores):
        best, at = 0.0, None
        for i in range(len(scores)):
            for j in range(i + 1, len(scores) + 1):
                s = sum(scores[i:j])
                if s > best or (s == best and at and j - i < at[1] - at[0]):
                    best, at = s, (i, j)
        if at is None:
            return []
        i, j = at
        left, right = plain(scores[:i]), plain(scores[j:])
        return left + [(i, j, best)] + [(a + j, b + j, s) for a, b, s in right]

    for _ in range(150):
        n = int(rng.integers(1, 25))
        hits = [(i, float(rng.choice([-3, -1, 1, 2, 5]))) for i in range(n) if rng.random() < 0.6]
        dense = [-0.25] * n
        for i, s in hits:
            dense[i] = s
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(hits, 0.25)]
        wanted = [(a, b, round(s, 6)) for a, b, s in plain(dense)]
        assert [g[2] for g in got] == [w[2] for w in wanted]


def test_hidden_markov_scores(spark, docs, rows):
    got = {r.doc_id: r for r in hmm.score_documents(docs).collect()}
    train = [t for i, t in rows if (xcrc(i)) % 7 != 2]
    counts = Counter(w for t in train for w in [*t.encode().lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    for i, text in rows:
        words = [*text.encode().lower().split(), b""]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (xcrc(i) % 7 == 2, len(words), sum(w in counts for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_hidden_markov_score_is_the_models(spark, docs, rows, monkeypatch):
    """The score of the whole query, recomputed text by text from the model; most words are not in the lexicon."""
    monkeypatch.setattr(hmm, "LEXICON", 300)
    monkeypatch.setattr(hmm, "SYMBOLS", 200)
    out, lm = hmm.scored_with_model(docs)
    counts = Counter(w for i, t in rows if xcrc(i) % 7 != 2 for w in [*t.encode().lower().split(), b""])
    ranked = sorted(counts, key=lambda w: (-counts[w], w))
    number = {w: i for i, w in enumerate(ranked[: len(lm.markov.emit) - 1])}
    total = sum(counts.values()) + len(counts) + 1
    mass = total - sum(counts[w] + 1 for w in number)
    for r in out.collect():
        words = [*dict(rows)[r.doc_id].encode().lower().split(), b""]
        own = [number.get(w, len(number)) for w in words]
        a, log = lm.markov.start, 0.0
        for i, s in enumerate(own):
            a = (a if i == 0 else a @ lm.markov.move) * lm.markov.emit[s]
            log += math.log10(a.sum())
            a = a / a.sum()
        log += sum(math.log10((counts[w] + 1) / mass) for w, s in zip(words, own) if s == len(number))
        assert math.isclose(r.score, log, rel_tol=1e-9)


def xcrc(i):
    import zlib

    return zlib.crc32(str(i).encode())


def hidden_markov(rng, states=3, symbols=4):
    return hmm.HiddenMarkov(rng.dirichlet([1] * states), rng.dirichlet([1] * states, states), rng.dirichlet([1] * symbols, states).T)


def packed(texts):
    return np.concatenate(texts).astype(np.int32), np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)


@pytest.mark.parametrize("row,held", [(512, 1024), (5, 1024), (3, 2)])
def test_forward_is_exact_and_normalised(monkeypatch, row, held):
    monkeypatch.setattr(hmm, "ROW", row)
    monkeypatch.setattr(hmm, "HELD_ROWS", held)
    model = hidden_markov(rng := np.random.default_rng(6))

    def plain(x):
        a = model.start * model.emit[x[0]]
        for s in x[1:]:
            a = (a @ model.move) * model.emit[s]
        return math.log10(a.sum())

    texts = [rng.integers(0, 4, n) for n in (1, 3, 5, 6, 17, 40, 1)]
    assert np.allclose(model.log10_likelihood(*packed(texts)), [plain(x) for x in texts])
    every = [np.array([a, b, c]) for a in range(4) for b in range(4) for c in range(4)]
    assert math.isclose((10 ** model.log10_likelihood(*packed(every))).sum(), 1.0)


@pytest.mark.parametrize("row,held", [(512, 1024), (4, 1024), (3, 2)])
def test_expected_counts_are_the_exact_posteriors(monkeypatch, row, held):
    """Against the sum over every path of states; rows shorter than the texts lose no move between them."""
    monkeypatch.setattr(hmm, "ROW", row)
    monkeypatch.setattr(hmm, "HELD_ROWS", held)
    from itertools import product

    model = hidden_markov(rng := np.random.default_rng(5), 2, 4)
    texts = [rng.integers(0, 4, n) for n in (1, 2, 4, 7, 9, 3, 8)]
    start, moves, emitted, likelihood = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2)), 0.0
    for x in texts:
        paths = list(product(range(2), repeat=len(x)))
        weight = np.array([model.start[p[0]] * math.prod(model.move[a, b] for a, b in zip(p, p[1:])) * math.prod(model.emit[s, q] for s, q in zip(x, p)) for p in paths])
        likelihood += math.log10(weight.sum())
        for p, w in zip(paths, weight / weight.sum()):
            start[p[0]] += w
            for a, b in zip(p, p[1:]):
                moves[a, b] += w
            for s, q in zip(x, p):
                emitted[s, q] += w
    got = model.expected(*packed(texts), 4)
    for mine, wanted in zip(got, (start, moves, emitted, likelihood)):
        assert np.allclose(mine, wanted, rtol=1e-4, atol=1e-5)
    assert math.isclose(got[1].sum(), sum(len(x) - 1 for x in texts), rel_tol=1e-4)


def test_baum_welch_climbs_over_all_texts(spark):
    """fit() against rounds over all texts in one process, with a text of several rows."""
    rng = np.random.default_rng(8)
    truth = hmm.HiddenMarkov(np.array([0.5, 0.5]), np.array([[0.95, 0.05], [0.1, 0.9]]), np.array([[0.6, 0.1], [0.3, 0.1], [0.05, 0.4], [0.05, 0.4]]))
    texts = []
    for length in [*rng.integers(5, 90, 60), 3000]:
        s, out = rng.integers(0, 2), []
        for _ in range(length):
            out.append(int(rng.choice(4, p=truth.emit[:, s])))
            s = rng.choice(2, p=truth.move[s])
        texts.append(out)
    flat, bounds = packed(texts)
    symbols = hmm.Symbols(np.bincount(flat, minlength=5).astype(float), np.ones(5))
    lm = hmm.fit(spark.createDataFrame([(x,) for x in texts], "symbols array<int>").repartition(3), symbols, states=2, tolerance=0.0)
    pairs = np.zeros((4, 4))
    for x in texts:
        for a, b in zip(x, x[1:]):
            pairs[a, b] += 1
    model = hmm.first_model(pairs, symbols, 2)
    for seen in lm.likelihoods:
        start, moves, emitted, likelihood = model.expected(flat, bounds, 5)
        assert math.isclose(seen, likelihood, rel_tol=1e-6)
        model = hmm.re_estimated(start, moves, emitted, symbols)
    assert np.allclose(lm.markov.move, model.move, rtol=1e-3) and np.allclose(lm.markov.emit, model.emit, rtol=1e-3)
    assert lm.likelihoods == sorted(lm.likelihoods) and model.log10_likelihood(flat, bounds).sum() > lm.likelihoods[0]


def test_decontamination(spark, docs, rows):
    benchmark = spark.read.parquet(f"{DATA}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    norm = lambda t: " ".join(re.sub(rb"[\s!-/:-@\[-`{-~]+", b" ", t.encode().lower()).decode().split())
    wanted = {(i, k) for i, t in rows for k, s in items.items() if f" {norm(s)} " in f" {norm(t)} "}
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_contamination(docs, benchmark).collect()}
    assert wanted and set(got) == wanted
    clean = {r.doc_id for r in decontaminate.clean_documents(docs, benchmark).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in wanted}


def test_decontamination_of_edited_and_short_items(spark):
    words = [f"word{i}" for i in range(60)]
    edited = [*words[:30], "other", *words[31:]]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "just four words here"), (3, ""), (4, None), (5, "one")], "item_id long, text string")
    inserted, cut = [*words[:20], "more", *words[20:]], [*words[:41], *words[42:]]
    texts = [(1, "Before it, " + " ".join(edited).upper() + " after."), (7, " ".join(inserted)), (8, "so " + " ".join(cut)), (2, "There are just four words here!"), (3, " ".join(reversed(words))), (4, ""), (5, None), (6, "only one here")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (7, 1), (8, 1), (2, 2), (6, 5)}


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(9)
    theirs = rng.integers(0, 2**63, 300, dtype=np.uint64)
    own = theirs[rng.integers(0, 300, 500)] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (4, 500)).astype(np.uint64), axis=0)
    indexed = (theirs, None, None, [decontaminate._piece(theirs, p, 3) for p in range(4)])
    wanted = {(i, j) for i, x in enumerate(own.tolist()) for j, y in enumerate(theirs.tolist()) if (x ^ y).bit_count() <= 3}
    assert {pair for a, b in decontaminate.near_windows(own, indexed, 3) for pair in zip(a.tolist(), b.tolist())} == wanted


def test_window_fingerprints(monkeypatch):
    monkeypatch.setattr(decontaminate, "_STEP", 50)
    grams = np.random.default_rng(1).integers(0, 2**63, 300, dtype=np.uint64)
    got = defaultdict(list)
    for size, at, f in decontaminate.window_fingerprints(grams, (3, 8)):
        assert at == len(got[size])
        got[size] += f.tolist()
    for size in (3, 8):
        wanted = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in grams[i : i + size]) > size) for i in range(len(grams) - size + 1)]
        assert got[size] == wanted


def test_words_have_the_library_ids(rows):
    pieces = sentencepieces.Pieces(sentencepieces._model(sentencepieces.MODEL))
    odd = ["", "  ", "a  b", "\n\n x\n", "▁▁a ▁b", "x" * 300, "a\tb\r\nc", "日本語のテキスト。", "<s> </s> <0x0A>", "\x00ab", "   lead", "trail   ", "😀😀 ok", "1234567890" * 20]
    for text in [t for _, t in rows] + odd:
        assert pieces.encode(text) == pieces.processor.encode(text)


def test_sentencepiece_scan_is_the_whole_encoding(rows):
    pieces = sentencepieces.Pieces(sentencepieces._model(sentencepieces.MODEL))
    texts = [t[:900] for _, t in rows[:25]] + ["", " ", "a", "  x   y ", "日本語 🙂 text", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 3, " " * 90, "x\ny\tz" * 20]
    for text in texts:
        for chunk in (32, 200):
            assert sentencepieces.encode_in_chunks(text, pieces, chunk) == pieces.processor.encode(text)


def test_products_are_associative(rows):
    """Any tree over the chunks gives one matrix, and the states it places lead to the whole encoding."""
    pieces = sentencepieces.Pieces(sentencepieces._model(sentencepieces.MODEL))
    rng = np.random.default_rng(12)
    for text in ["aaaaaaaaa" * 40, "".join(t[:60] for _, t in rows[:15]), "  x   y " * 50 + "日本語 🙂"]:
        text = sentencepieces.escaped(text)
        bounds = sentencepieces.chunk_bounds(len(text), 32, pieces.longest)
        nodes = [pieces.transfer(text, a, b, a == 0) for a, b in bounds]
        left = sentencepieces.reduce(sentencepieces.joined, nodes)
        for _ in range(5):
            own = list(nodes)
            while len(own) > 1:
                i = int(rng.integers(0, len(own) - 1))
                own[i : i + 2] = [sentencepieces.joined(own[i], own[i + 1])]
            assert own[0][:2] == left[:2] and (own[0][2] == left[2]).all()
        half = len(nodes) // 2
        parts = [sentencepieces.reduce(sentencepieces.joined, x) for x in (nodes[:half], nodes[half:])]
        (a, b), (c, d) = sentencepieces.scan(parts)
        index = lambda states, s: states.index(s)
        on = sentencepieces.scan(nodes[:half], index(nodes[0][0], a), index(nodes[half - 1][1], b)) + sentencepieces.scan(nodes[half:], index(nodes[half][0], c), index(nodes[-1][1], d))
        assert on == sentencepieces.scan(nodes)
        made = pieces.ids([p for (x, y), (enter, leave) in zip(bounds, on) for p in pieces.traced(text, enter, leave, x, y)])
        assert made == pieces.processor.encode(text.removeprefix("▁").replace("▁", " "))


@pytest.mark.parametrize("fan", [16, 2])
def test_sentencepiece_in_spark(spark, docs, rows, monkeypatch, fan):
    """Texts of one chunk and of many, over one level of products and over several; ids, and what they decode to."""
    monkeypatch.setattr(sentencepieces, "FAN", fan)
    pieces = sentencepieces.Pieces(sentencepieces._model(sentencepieces.MODEL))
    more = spark.createDataFrame([(-1, "日本語 🙂 \x00 é" * 300), (-2, "x" * 3000), (-3, " lead  and trail " * 200), (-4, None), (-5, "")], "doc_id long, text string")
    some = docs.where(F.length("text") < 4000).select("doc_id", "text").union(more)
    texts = {r.doc_id: r.text or "" for r in some.collect()}
    got = {r.doc_id: r for r in sentencepieces.encode_and_decode(some, chunk=300).collect()}
    assert {i: list(r.ids) for i, r in got.items()} == {i: pieces.processor.encode(t) for i, t in texts.items()}
    for i, r in got.items():
        back = pieces.processor.decode(list(r.ids)) if r.ids else ""
        assert (r.n_tokens, r.decoded_chars, r.decoded_sha256) == (len(r.ids), len(back), hashlib.sha256(back.encode()).hexdigest())
    if fan == 16:
        encoded = sentencepieces.encode(some, chunk=300)
        assert {r.doc_id: r.text for r in sentencepieces.decode(encoded).collect()} == texts


def test_hashed_words():
    texts = [b"", b"a  B\tc", b" x", b"tail ", b"\n", b"\xc3\xa9 a"]
    words, bounds = hashed_words(texts, byte_class(SPACES))
    assert np.diff(bounds).tolist() == [0, 3, 1, 1, 0, 2] and words[0] == words[-1] and len(set(words.tolist())) == 6
