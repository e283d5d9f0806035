"""Fill-in-middle, alignment and URL filters against plain versions, with odd rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillmill.llm import alignment, fill_middle, url_filter
from quillmill.llm.queries import QUERIES, URL_RULES

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n string, form string, row string, digest string, part string"
TEXTS = [(1, None), (2, ""), (3, "a"), (4, "one <S> two"), (5, "ünï▁code 日本語 🎉🎉 x"), (5, "ünï▁code 日本語 🎉🎉 x"), (6, "日本語 🎉🎉 text  with   spaces\n\nand lines"), (None, "no id at all"), (None, None), (7, "<|endoftext|> </s> <s> <unk>"), (8, "é" * 5000), (9, " lead 12345 don't"), (10, "x" * 70_000), (11, "\x00\x01 control \ufffd")]


@pytest.fixture(scope="module")
def odd(spark):
    copies = [(100 + i, "the same text in many rows") for i in range(700)]
    return spark.createDataFrame([(i, t, *["z"] * 5) for i, t in TEXTS + copies], SCHEMA)


@pytest.mark.parametrize("values", [[0], [0, 5], [3, 3, 3, 900], list(range(5000)), [4 * i for i in range(5000)], [0] * 3000 + [7]])
def test_elias_fano(values):
    # Values a code point's width apart at most, as boundary lists have, and others close by.
    made = fill_middle.EliasFano.unpack(fill_middle.EliasFano.of(np.array(values)).pack())
    assert [made.select(k) for k in range(len(values))] == values


@pytest.mark.parametrize("text", ["a", "é" * 4000, "a日🎉" * 3000, "plain words " * 900])
def test_boundaries(text):
    made = fill_middle.boundaries(text.encode())
    ends = np.cumsum([0, *[len(c.encode()) for c in text]])
    assert [made.select(k) for k in range(0, len(text) + 1, 7)] == ends[::7].tolist()


def plain_fill(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def key(row):
    return tuple(map(str, row))


def test_fill_middle(spark, odd):
    for docs in (odd, spark.read.parquet(f"{DATA}/documents.parquet")):
        made = fill_middle.transform(docs).withColumn("back", fill_middle.restored())
        rows = docs.select("doc_id", F.coalesce("text", F.lit(""))).collect()
        assert sorted(key(r[:6]) for r in made.collect()) == sorted(key(plain_fill(*r)) for r in rows)
        assert sorted(key((r.doc_id, r.back)) for r in made.collect()) == sorted(map(key, rows))
    assert fill_middle.transform(odd.limit(0)).count() == 0


def test_distinct_texts_are_indexed_once(spark, odd):
    index = fill_middle.text_index(odd)
    entries = index.groupBy("text").count().collect()
    parts = -(-700 // fill_middle.SHARED)
    assert {r["count"] for r in entries if "same" not in r.text} == {1} and [r["count"] for r in entries if "same" in r.text] == [parts]
    sizes = [r[0] for r in index.select(F.size("members")).collect()]
    assert sum(sizes) == odd.count() and max(sizes) < 2 * fill_middle.SHARED


def test_restoring_text_that_nearly_has_markers(spark):
    texts = [(i, "a<" * i + "<P" + "S>" * i + "<") for i in range(60)]
    made = fill_middle.transform(spark.createDataFrame(texts, "doc_id long, text string")).select("doc_id", fill_middle.restored().alias("back"))
    assert sorted(map(tuple, made.collect())) == texts


def plain_alignment(rows):
    a_tok, b_tok = Tokenizer.from_file(alignment.BYTES_MODEL), sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES_MODEL)
    a_tok.encode_special_tokens = True
    letters, names = alignment.byte_letters(), {i: t for t, i in a_tok.get_vocab().items()}
    every = []
    for doc_id, text in rows:
        raw = f" {text}".encode() if text else b""
        a = a_tok.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        ab = [bytes(letters[c] for c in names[i]) for i in a]
        bb = [bytes([int(b_tok.id_to_piece(i)[3:-1], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(ab) != raw or b"".join(bb) != raw:
            a, b, ab, bb = [], [], [], []
        ea, eb = np.cumsum([0, *map(len, ab)]).tolist(), np.cumsum([0, *map(len, bb)]).tolist()
        cuts = sorted(set(ea[1:]) & set(eb[1:]))
        groups, before = [], 0
        for c in cuts:
            groups.append(",".join(str(a[i]) for i in range(len(a)) if before < ea[i + 1] <= c) + "|" + ",".join(str(b[j]) for j in range(len(b)) if before < eb[j + 1] <= c))
            before = c
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if ea[i] < eb[j + 1] and eb[j] < ea[i + 1]]
        every.append((doc_id, a, b, groups, links))
    counts = Counter(p for *_, links in every for p in links)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for doc_id, a, b, groups, links in every:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), sha))
    return out, counts


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("held", [alignment.HELD, 400, 0])
def test_alignment(spark, odd, held):
    real = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) < 1500 and doc_id % 4 = 0").select("doc_id", "text")
    docs = odd.where("length(text) < 6000 or text is null").select("doc_id", "text").limit(60).union(real)
    wanted, counts = plain_alignment([tuple(r) for r in docs.collect()])
    got = alignment.link_statistics(docs.repartition(5), held=held).select(*NAMES).collect()
    assert sorted(map(key, got)) == sorted(map(key, wanted)) and sum(w[1] for w in wanted) > 1000
    if held == 400:
        assert {(r.a_id, r.b_id): r.n for r in alignment.pair_counts(docs).collect()} == counts


def test_aligned_tokens(spark, odd):
    """Groups by their token ends cover the same bytes in both vocabularies."""
    a, b = (open(p, "rb").read() for p in (alignment.BYTES_MODEL, alignment.PIECES_MODEL))
    pair = alignment.Pair(a, b)
    for r in alignment.align(odd).collect():
        at = [0, 0]
        for i, j in zip(r.a_ends, r.b_ends):
            assert b"".join(pair.a.bytes[x] for x in r.a_ids[at[0] : i]) == b"".join(pair.b.bytes[x] for x in r.b_ids[at[1] : j])
            at = [i, j]
        assert at == [len(r.a_ids), len(r.b_ids)]
    assert alignment.align(odd.limit(0)).count() == alignment.link_statistics(odd.limit(0)).count() == 0


def test_ids_are_those_of_the_library(spark):
    """A's ids equal the file's own tokenizer, for every character in several surroundings."""
    tokens, library = alignment.ByteTokens(open(alignment.BYTES_MODEL, "rb").read()), Tokenizer.from_file(alignment.BYTES_MODEL)
    library.encode_special_tokens = True
    texts = [" " + " ".join(f"a{chr(c)}b 1{chr(c)}2 .{chr(c)}" for c in range(i, i + 64) if not 0xD800 <= c < 0xE000) for i in range(0, 0x3400, 64)] + ["<|endoftext|> x"]
    assert [x.tolist() for x in tokens.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("keys", [[], [0], [5, 9, 70_000, 2**31, 2**40]])
def test_packed_pairs(keys):
    keys = np.array(keys, dtype=np.int64)
    for times in (np.arange(len(keys)) + 1, np.arange(len(keys)) + 254):
        k, t = alignment.unpack(alignment.pack(keys, times))
        assert k.tolist() == keys.tolist() and t.tolist() == times.tolist()


def test_task_counts_in_bounded_memory(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    wanted = sorted(map(tuple, alignment.pair_counts(docs).collect()))
    monkeypatch.setattr(alignment, "COUNTED", 500)
    assert sorted(map(tuple, alignment.pair_counts(docs).collect())) == wanted


def plain_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)] if host else []
    return host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else None


def link(href):
    return f'<html><head><LINK href="{href}" rel="nofollow Canonical"></head>x</html>'


PAGES = [
    (1, "https://a.net/en/1", link("https://bad.example.com/en/9")),  # blocked by its canonical address
    (2, "https://b.net/en/2#frag", "<meta content='0; URL=https://a.net/en/1' http-equiv=refresh>"),  # and what leads there
    (3, "https://c.net/en/3", link("/fr/3")),  # a relative target that a rule blocks
    (4, "https://www.example.com/en/4", link("https://a.net/en/1")),  # an allow of its own
    (5, "https://d.net/en/5", "<!-- " + link("https://bad.example.com/en/9") + " -->"),
    (6, "https://e.net/en/6", "<script>'" + link("https://bad.example.com/en/9") + "'</script>"),
    (7, "https://f.net/en/7", link("https://g.net/en/7")),
    (8, "https://G.net/en/7", None), (9, None, link("https://bad.example.com/en/9")), (10, "no address", ""), (11, "", None), (12, "http://X.Y.NET/es/?q#f", "x"),
    (13, "https://h.net/en/13", '<base href="https://k.net/fr/"><link rel=canonical href=x.html>'), (None, "https://a.net/en/1", None), (1, "https://a.net/en/1", None),
    (14, "https://i.net", link("javascript:void(0)")), (15, "https://example.com/en/", ""), (16, "https://notexample.com/en/", ""), (17, "a://b://c.com/x", ""), (18, "https://j.net/en/", "<meta http-equiv='refresh' content='5'>"),
    (19, "https://l.net/en/", "<!-- open" + link("https://bad.example.com/en/9")), (20, "https://m.net/en/", '<link rel="stylesheet" href="https://bad.example.com/en/9">'),
]
ALIASES = {1, 2, 3, 13}


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, h, "r", "n") for i, u, h in PAGES], "page_id long, url string, html string, rule string, node string")
    rules = spark.createDataFrame(URL_RULES + [(None, "/", "block"), ("net", None, "block"), ("", "/", "block"), ("net", "/", "perhaps"), ("com", "/", "block")], "host string, path string, verdict string")
    got = url_filter.judge(pages, rules).collect()
    wanted = []
    for i, url, _ in PAGES:
        host, path, rule, verdict = plain_rule(url, URL_RULES)
        alias = i in ALIASES or url == "https://a.net/en/1"
        wanted.append((i, host, path, rule, verdict or ("block" if alias else "allow")))
    assert sorted(key(r[:5]) for r in got) == sorted(map(key, wanted))
    roots = {r.page_id: r.root for r in got}
    assert roots[1] == roots[2] == roots[4] == "https://a.net/en/1" and roots[7] == roots[8] == "https://f.net/en/7" and roots[5] is None
    redirects = spark.createDataFrame([("https://j.net/en/", "https://f.net/en/7"), ("https://g.net/en/7", "https://z.net/es/0"), (None, "https://bad.example.com/en/9")], "source string, target string")
    more = {r.page_id: r.verdict for r in url_filter.judge(pages, rules, redirects).collect()}
    assert [i for i in (7, 8, 18) if more[i] == "block"] == [7, 8, 18]
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_rules_against_plain(spark):
    rng = np.random.default_rng(5)
    pick = lambda *x: str(rng.choice(x))
    rules = list({(h, p): (h, p, pick("allow", "block")) for h, p in ((pick("com", "a.com", "b.a.com", "com:80", "c"), pick("", "/", "/x", "/xy/", "/x/y")) for _ in range(40))}.values())
    urls = [f"http://{pick('', 'b.', 'B.a.', 'q.c.')}{pick('a.com', 'com', 'c', 'com:80', 'xcom')}{pick('', '/', '/x', '/xy/z', '/x/y?r', '?x', '#x/y')}" for _ in range(300)]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = {r.url: (r.rule, r.decision) for r in url_filter.longest_rules(spark.createDataFrame([(u,) for u in urls], "url string"), table).collect()}
    for u in urls:
        rule, verdict = plain_rule(u, rules)[2:]
        assert found.get(u, (None, None)) == (rule, verdict), u


def test_queries_read_whole_tables(spark):
    n = {name: spark.read.parquet(f"{DATA}/{name}.parquet").count() for name in ("documents", "pages")}
    assert QUERIES["op11_fill_middle"](spark, DATA).count() == QUERIES["op12_alignment"](spark, DATA).count() == n["documents"] and QUERIES["op13_url_filter"](spark, DATA).count() == n["pages"]
