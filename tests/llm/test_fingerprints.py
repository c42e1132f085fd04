"""Fingerprints against edit distance, and their bands against all pairs."""

import random
from itertools import combinations

from test_operators import FOLDER, Groups, documents

from campuslake.llm import fingerprints
from campuslake.llm.queries import QUERIES


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def altered(text, share, rng):
    out = list(text)
    for _ in range(max(1, int(len(text) * share))):
        at = rng.randrange(len(out) + 1)
        out[at : at + rng.randrange(2)] = rng.choice(["", "x", "qz", "e"])
    return "".join(out)


def copies(spark, shares, seed=3):
    rng, docs = random.Random(seed), documents(spark)
    out = dict(docs)
    for i, text in docs.items():
        for share in shares:
            out[len(out) + 1_000_000] = altered(text or "", share, rng)
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)


def test_walk_follows_edit_distance(spark):
    rng, texts = random.Random(1), [t[:600] for t in documents(spark).values() if t and len(t) >= 400][:12]
    told = {}
    for share in (0.002, 0.02, 0.1):
        likely = []
        for text in texts:
            near = altered(text, share, rng)
            assert edit_distance(text, near) <= 2 * max(1, int(len(text) * share))
            one, two = fingerprints.fingerprints([text, near])
            likely.append(fingerprints.likeness(one, two))
        told[share] = sum(likely) / len(likely)
    unlike = [fingerprints.likeness(*fingerprints.fingerprints([a, b])) for a, b in zip(texts, texts[1:], strict=False)]
    assert told[0.002] > 0.9 and told[0.002] > told[0.02] > told[0.1] > sum(unlike) / len(unlike)


def test_bands_find_what_all_pairs_find(spark):
    texts = copies(spark, (0.001, 0.01, 0.02))
    prints = dict(zip(texts, fingerprints.fingerprints([t or "" for t in texts.values()]), strict=True))
    near = [(a, b) for a, b in combinations(sorted(prints), 2) if fingerprints.likeness(prints[a], prints[b]) >= 0.8]
    keys = {i: set(fingerprints.band_keys(p).tolist()) for i, p in prints.items()}
    met = [bool(keys[a] & keys[b]) for a, b in near]
    assert len(near) > 100 and sum(met) / len(met) >= 0.95
    # of those that share a key, no component is lost
    groups, all_near = Groups(prints), Groups(prints)
    for (a, b), shared in zip(near, met, strict=True):
        all_near.join(a, b)
        if shared:
            groups.join(a, b)
    rows = spark.createDataFrame([(i, p) for i, p in prints.items()], "doc_id long, fingerprint string")
    got = {r["doc_id"]: r["near_component"] for r in fingerprints.near_groups(rows).collect()}
    assert got == {i: groups.find(i) for i in prints}
    assert sum(got[i] == all_near.find(i) for i in prints) / len(prints) >= 0.95
    for r in fingerprints.near_documents(frame(spark, texts)).collect():
        assert r["likeness"] == fingerprints.likeness(prints[r["a"]], prints[r["b"]]) >= 0.8 and r["a"] > r["b"]


def test_a_crowd_in_one_bucket_keeps_its_links(spark, monkeypatch):
    """Bands of three bits: buckets of many unlike nodes. Those like each other but not the smallest are found."""
    monkeypatch.setattr(fingerprints, "BANDS", 2)
    monkeypatch.setattr(fingerprints, "BAND_BITS", 3)
    monkeypatch.setattr(fingerprints, "_drawn", fingerprints._drawn.__wrapped__)
    texts = {i: t for i, t in copies(spark, (0.005,)).items() if t and len(t) > 200}
    prints = dict(zip(texts, fingerprints.fingerprints(list(texts.values())), strict=True))
    keys = {i: fingerprints.band_keys(p).tolist() for i, p in prints.items()}
    groups, links = Groups(prints), 0
    for a, b in combinations(sorted(prints), 2):
        if set(keys[a]) & set(keys[b]) and fingerprints.likeness(prints[a], prints[b]) >= 0.8:
            groups.join(a, b)
            links += 1
    assert links > 50
    nodes = spark.createDataFrame(list(prints.items()), "node long, fingerprint string")
    keyed = spark.createDataFrame([(i, k) for i in prints for k in keys[i]], "node long, key long")
    monkeypatch.setattr(fingerprints, "shared_buckets", lambda _, own=fingerprints.shared_buckets: own(keyed))
    placed = dict(map(tuple, fingerprints.components(fingerprints._links(nodes, 0.8).select("a", "b")).collect()))
    assert {i: placed.get(i, i) for i in prints} == {i: groups.find(i) for i in prints}


def test_pairs_within_a_key_are_links(spark):
    """The join of a key's nodes makes no row of nodes that are unlike, whatever their numbers of samples."""
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    texts = {i: altered(base[: rng.choice([1, 8, 30, 60, 64, 65, 130, 300, 700, 1490, 1500])], rng.choice([0.005, 0.02, 0.1]), rng) for i in range(120)}
    prints = dict(zip(texts, fingerprints.fingerprints(list(texts.values())), strict=True))
    rows = []
    for i, p in prints.items():
        bits = fingerprints._sampled(p)
        padded = "".join(map(str, bits)).ljust(-(-len(bits) // 64) * 64, "0")
        words = [int(padded[k : k + 64], 2) for k in range(0, len(padded), 64)]
        words = [w - (1 << 64) if w >> 63 else w for w in words]
        rows.append((1, i, i, 0.0, len(bits), float(fingerprints.sample_weights(len(bits)).sum()), words))
    told = spark.createDataFrame(rows, "key long, node long, at long, distance double, count int, weight double, words array<long>")
    every = {(a, b): fingerprints.likeness(prints[a], prints[b]) for a in prints for b in prints if a > b}
    for likely in (0.0, 0.5, 0.8):
        got = {(a, b): likeness for a, b, likeness in fingerprints._alike(told, likely).collect()}
        assert got == {pair: x for pair, x in every.items() if x >= likely}
    nodes = spark.createDataFrame(list(prints.items()), "node long, fingerprint string")
    count = fingerprints.F.expr("cast(conv(substring(fingerprint, 1, 4), 16, 10) as int)")
    assert {r["node"]: r["w"] for r in nodes.select("node", fingerprints._words(count).alias("w")).collect()} == {r[1]: r[6] for r in rows}


def test_odd_documents_and_query(spark, odd_docs, no_docs):
    got = fingerprints.near_groups(fingerprints.fingerprint_edits(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: r["near_component"] for r in got}
    assert (by_id[1], by_id[2], by_id[3], by_id[5], by_id[None]) == (1, 2, 2, 5, None)
    assert fingerprints.near_groups(fingerprints.fingerprint_edits(no_docs)).count() == 0
    assert fingerprints.near_documents(no_docs).count() == 0
    found = QUERIES["op7_fingerprints"](spark, FOLDER)
    assert found.count() == len(documents(spark)) and found.where("near_component > doc_id or near_component is null").count() == 0
