"""Operators against brute force on small tables, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollcall.llm import decontaminate, fingerprint, license_scan, line_dedup, near_dedup, packing, pii, quality_knn, suffix_dedup, url_filter
from rollcall.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, hash string, rank int, chunk int, found string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    passage = words(rng, 70)
    texts = {i: "\n".join(words(rng, rng.randint(3, 40)) + "." for _ in range(rng.randint(1, 12))) for i in range(60)}
    for i in range(60, 75):
        texts[i] = texts[i - 60]
    for i in range(75, 90):
        parts = texts[i - 60].split(" ")
        parts[len(parts) // 2] = "changed"
        texts[i] = " ".join(parts)
    for i in range(90, 100):
        texts[i] = words(rng, i - 88) + "\n" + passage + "\n" + words(rng, 30)
    texts[100], texts[101], texts[102] = "", None, "é" * 500
    texts[103] = "mail me@x.org_y@z.com +1 (310) 555-4510 at 10.0.0.256 or 1.2.3.4, card 4111 1111 1111 1111, token = " + "0a" * 20
    texts[104] = "Licensed under the Apache License, Version 2.0.\nReleased under the MIT license! cc by-nc"
    return texts


@pytest.fixture(scope="module")
def docs(spark, corpus):
    prepare(spark)
    rows = [(i, t, "en", "s", None if t is None else len(t), "x", "y", 1, 2, "z") for i, t in corpus.items()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def odd(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None), (1, None), (2, ""), (None, "a b c d e f g\n" * 3), (None, "a b c d e f g\n" * 3), (3, long), (3, long), (4, "\n\n \n")]
    return spark.createDataFrame([(i, t, None, None, None, None, None, None, None, None) for i, t in rows], DOCS)


def test_suffix_dedup_equals_brute_force(docs, corpus):
    raw = {i: (t or "").encode() for i, t in corpus.items()}
    seen = Counter(v[i : i + 200] for v in raw.values() for i in range(len(v) - 199))
    expected = set()
    for key, v in raw.items():
        gone = bytearray(len(v))
        for i in range(len(v) - 199):
            if seen[v[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(v, gone, strict=True) if not g)
        expected.add((key, len(v), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    for chunk in (700, 2_000_000):
        assert {tuple(r) for r in suffix_dedup.removals(docs, chunk).collect()} == expected


def test_cover_is_a_perfect_difference_set():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_pii_base_equals_plain_patterns(spark, docs, corpus):
    rng = random.Random(3)
    noise = {1000 + i: "".join(rng.choice("a1.@- +4()_é") for _ in range(200)) for i in range(150)}
    more = spark.createDataFrame(list(noise.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.summary(pii.spans(docs.select("doc_id", "text").union(more))).collect()}
    for key, text in {**corpus, **noise}.items():
        base = [f"{k}:{m.start()}:{m.end()}" for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if passes(k, m.group())]
        assert got[key]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest(), text
        assert set(base) <= set(got[key]["spans"].split(",")) | {""}
    assert "secret:" in got[103]["spans"] and got[103]["n_card"] == 1


def test_em_learns_that_a_labeler_is_unreliable():
    table = [(2, "yyyy-", 80), (2, "ynny-", 10), (2, "nnnn-", 80), (2, "nnny-", 60)]
    _, told, true = pii.reliabilities(table)
    assert true[2, "yyyy-"] > 0.9 and true[2, "nnnn-"] < 0.1
    assert told[0, 1, "y"] - told[0, 0, "y"] > told[3, 1, "y"] - told[3, 0, "y"]
    assert pii.train([]) == [0.0] * 11


def test_url_rules_and_reputation(spark):
    urls = [
        None, "nothing", "HTTP://A.Example.ORG/es/x?q", "http://example.org/en/12", "http://b.com/fr/1", "http://b.com/de/1", "http://xorg/", "http://bad.net/a",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(100 + i, f"http://{'bad' if i % 2 else 'good'}.net/{i}") for i in range(80)], "page_id long, url string")
    outcomes = spark.createDataFrame([(100 + i, 0 if i % 2 else 1) for i in range(80)], "page_id long, good int")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, outcomes).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[3][2:] == ("example.org/en/1", "block")
    assert (got[4][3], got[5][3], got[6][2], got[7][3], got[100][3]) == ("allow", "block", None, "block", "allow")
    empty = url_filter.judge(pages.limit(0), outcomes.limit(0))
    assert empty.count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_line_links_equal_brute_force(spark):
    rng = random.Random(8)
    lines = [words(rng, 9) for _ in range(25)]
    for line in lines[:15]:
        for _ in range(3):
            cut = list(line)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(cut))
                cut[at : at + rng.randint(0, 1)] = rng.choice(["z", "", "zq"])
            lines.append("".join(cut).strip())
    rng.shuffle(lines)
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    first = {line: i for i, line in reversed(list(enumerate(lines)))}
    distinct = [x for x in first if len(x) >= line_dedup.NEAR_FROM]
    links = {x: [y for y in distinct if x != y and abs(len(x) - len(y)) <= 2 and edit_distance(x, y) <= 2] for x in distinct}
    got = {r["doc_id"]: r for r in line_dedup.report(docs).collect()}
    for i, line in enumerate(lines):
        near = first[line] == i and any(first[y] < i for y in links.get(line, []))
        assert (got[i]["n_exact"], got[i]["n_near"], got[i]["n_links"]) == (int(first[line] != i), int(near), len(links.get(line, [])))


def shingle_bag(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_dedup_equals_brute_force(docs, corpus):
    bags = {i: shingle_bag(t) for i, t in corpus.items()}
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in bags:
        for j in bags:
            if i < j:
                both, either = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
                if not either or both / either >= near_dedup.THRESHOLD:
                    root[max(find(i), find(j))] = min(find(i), find(j))
    expected = {i: find(i) for i in bags}
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == expected
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(expected.values())


def test_decontamination_equals_brute_force(spark, docs, corpus):
    def runs(text):
        w = [x for x in re.split(r"[^\w]+", (text or "").lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    items = {1: " ".join(corpus[3].split()[:30]), 2: "too short", 3: corpus[90].split("\n")[1], 4: "none of these words is in any of the documents", 5: None}
    frame = spark.createDataFrame(list(items.items()), "item_id long, text string")
    expected = {}
    for i, text in corpus.items():
        held = [k for k, t in items.items() if runs(t) and len(runs(t) & runs(text)) >= 0.8 * len(runs(t))]
        expected[i] = ",".join(map(str, held))
    got = {r["doc_id"]: r["items"] for r in decontaminate.judge(docs, frame).collect()}
    assert got == expected
    clean = decontaminate.drop_contaminated(docs, frame)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, x in expected.items() if not x}


def test_packing_is_an_exact_round_trip(docs, corpus):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.VOCABULARY)
    rows = packing.pack(packing.pieces(docs)).collect()
    ids = {i: [*encode.encode(t or "", add_special_tokens=False).ids, 2] for i, t in corpus.items()}
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    bins = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-sum(map(len, ids.values())) // 1024) * 1.1 + 1


def test_license_base_places(docs, corpus):
    got = {r["doc_id"]: r for r in license_scan.summary(license_scan.scan(docs)).collect()}
    for i, text in corpus.items():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        places = [(k, label) for phrase, label in license_scan.BASE.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        assert (got[i]["n_words"], got[i]["n_base"]) == (len(w), len(places))
        assert got[i]["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert got[i]["first_word"] == min([k for k, _ in places], default=None)
    assert got[104]["base_labels"] == "apache-2,cc-by-nc,mit"


def test_fingerprints_follow_the_next_document(docs, corpus):
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    order = sorted(corpus)
    for i, key in enumerate(order):
        text, following = corpus[key] or "", corpus[order[(i + 1) % len(order)]] or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        assert got[key]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[key]["n_chars"] == len(text)
    for i in range(60, 75):
        assert got[i]["fingerprint"] == got[i - 60]["fingerprint"]


def test_quality_votes_separate_held_out_rows(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 60) if i % 3 else " ".join(["BUY!!"] * 40 + ["$$$"] * 10), int(i % 3 > 0)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_knn.fit_documents(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    got = quality_knn.classify(frame, model).collect()
    assert {r["held_out"] for r in got} == {True, False}
    assert all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


@pytest.mark.parametrize("name", ["odd", "empty"])
def test_odd_and_empty_tables(spark, name, tmp_path):
    prepare(spark)
    frame = odd(spark) if name == "odd" else odd(spark).limit(0)
    n = frame.count()
    labels = spark.createDataFrame([(3, 1, 0), (3, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(None, "a b c d e f g"), (1, None)], "item_id long, text string")
    if name == "empty":
        labels, items = labels.limit(0), items.limit(0)
    model = quality_knn.fit_documents(frame, labels)
    assert quality_knn.classify(frame, model).count() == n
    assert suffix_dedup.removals(frame).count() == n
    assert line_dedup.report(frame).count() == frame.select("doc_id").distinct().count()
    assert packing.pack(packing.pieces(frame)).filter("piece = 0").count() == n
    assert license_scan.summary(license_scan.scan(frame)).count() == n
    assert fingerprint.fingerprints(frame).count() == n
    assert near_dedup.classes(frame).count() == n
    assert decontaminate.judge(frame, items).count() == n
    assert pii.summary(pii.spans(frame)).count() == n
    for table, df in (("documents", frame), ("labels", labels), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{table}.parquet")
    stage = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.columns == frame.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.count("*")).first()[0] >= 0
