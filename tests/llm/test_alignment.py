"""Token alignment against a plain count of all documents, and on odd texts."""

import hashlib
from collections import Counter

import pytest

from campuslake.llm.alignment import Pair, align_documents, alignment_digests, link_sums, pair_counts
from campuslake.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
PATHS = [tokenizer_path(), tokenizer_path("piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def pair():
    return Pair(*PATHS)


def groups_of(a, b, pair):
    """Token by token: a group ends where both have read the same bytes."""
    ends, at = {}, 0
    for k, i in enumerate(a):
        at += len(pair.bytes_a[i])
        ends[at] = k + 1
    groups, at, from_a, from_b = [], 0, 0, 0
    for k, i in enumerate(b):
        at += len(pair.bytes_b[i])
        if at in ends:
            groups.append((a[from_a : ends[at]], b[from_b : k + 1]))
            from_a, from_b = ends[at], k + 1
    return groups


def expected(docs, pair):
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    one.encode_special_tokens = True
    found, links = [], Counter()
    for i, text in docs:
        a, b = (one.encode(f" {text}", add_special_tokens=False).ids, two.encode(text)) if text else ([], [])
        raw = f" {text}".encode()
        if b"".join(pair.bytes_a[x] for x in a) != raw or b"".join(pair.bytes_b[x] for x in b) != raw:
            a, b = [], []
        groups = groups_of(a, b, pair)
        links.update((x[-1], y[-1]) for x, y in groups)
        found.append((i, len(a), len(b), groups))
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    out = []
    for i, n_a, n_b, groups in found:
        own = [links[x[-1], y[-1]] for x, y in groups]
        best = sum(n == most[y[-1]] for n, (_, y) in zip(own, groups, strict=True))
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, n_a, n_b, len(groups), len(groups), best, sum(own), hashlib.sha256(told.encode()).hexdigest() if told else ""))
    return sorted(out, key=str), links


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_alignment_is_a_plain_count(spark, pair):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    want, links = expected(docs, pair)
    assert rows(QUERIES["op11_align_tokens"](spark, FOLDER)) == want
    counts = pair_counts(align_documents(spark.createDataFrame(docs, "doc_id long, text string"), *PATHS), pair.same)
    assert {(r["a"], r["b"]): r["n"] for r in counts.collect()} == dict(links)
    plain = [(a, b) for a, b in links if pair.same[a] == b]
    assert 0 < len(plain) < len(links)
    for b in {b for _, b in links}:
        own = {a: n for (a, y), n in links.items() if y == b}
        assert {r["a"] for r in counts.where(f"b = {b} and best").collect()} == {a for a in own if own[a] == max(own.values())} if b % 997 == 0 else True


def test_odd_texts(spark, pair):
    texts = ["▁x", "<|endoftext|> a <s> </s>", None, "", " ", "  a\x00b\r\n\t", "Ünï çödé 漢字 😀 \U0001f468‍\U0001f469", "<0x41> ⁇ ﬁ ½",
             "again", "again", "x" * 30_000, "<unk>", "a.b." * 5000, "  \x1c"]
    docs = [(i // 2 if i % 5 else None, t) for i, t in enumerate(texts)]
    found = spark.createDataFrame([(*d, "n", 1) for d in docs], "doc_id long, text string, pair string, row int")
    assert rows(alignment_digests(found, *PATHS)) == expected(docs, pair)[0]
    assert alignment_digests(found.where("false"), *PATHS).count() == 0


def test_odd_documents(spark, odd_docs, no_docs, pair):
    got = alignment_digests(odd_docs, *PATHS)
    assert got.count() == odd_docs.count() and alignment_digests(no_docs, *PATHS).count() == 0
    assert got.where("doc_id in (2, 3)").agg({"n_a": "sum", "count_sum": "sum"}).first()[:] == (0, 0)
    assert {r["groups_sha256"] for r in got.where("doc_id = 2").collect()} == {""}


def test_equal_bytes_map_one_to_one(pair):
    known = [b for b in pair.same.tolist() if b >= 0]
    assert len(known) == len(set(known)) > 5000
    assert all(pair.bytes_a[a] == pair.bytes_b[b] for a, b in enumerate(pair.same.tolist()) if b >= 0)


def test_one_pair_in_most_links(spark, pair):
    docs = [(i, "the " * 400 + f"word{i}") for i in range(60)] + [(99, "qzxj kwv")]
    found = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    aligned = align_documents(found, *PATHS)
    sums = link_sums(aligned, pair_counts(aligned, pair.same), pair.same).drop("row")
    assert rows(sums) == expected(docs, pair)[0]
