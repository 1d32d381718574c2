"""Registered queries over small tables, all their columns against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, score double, _row int"
TONGUES = {
    "ab": "bada bab abba daba adab babad abad badab dada abda".split(),
    "xy": "xylo yxo oxyl loxy xoyl ylox oxo yoly xolo lyxo".split(),
}
GOOD = "reason evidence careful measure result therefore method study shows detail".split()
BAD = "click win free cash now buy cheap offer subscribe prize".split()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(rng, words, count):
    return " ".join(rng.choice(words) for _ in range(count))


def documents():
    rng = random.Random(17)
    passage = sentence(rng, GOOD + BAD, 60)
    rows = []
    for i in range(120):
        lang = ("ab", "xy")[i % 2]
        text = sentence(rng, TONGUES[lang], rng.randint(5, 60))
        if i % 9 == 0:
            text = f"{text} {passage} {sentence(rng, TONGUES[lang], 4)}"
        if i % 10 == 0:
            text += f' password = "{"aB3/" * rng.randint(2, 5)}" AKIA{"Q7" * rng.randint(6, 9)}'
        if i % 11 == 0:
            text = "é漢 " + text + " token:" + "ab12" * rng.randint(3, 8) + " 0123456789abcdef01"
        # Two thirds of all rows are of one source; the others have three, one of them NULL.
        rows.append((i, text, lang, "web" if i % 3 else (None, "books", "code")[i // 3 % 3]))
    copy = rows[7]
    rows += [(200 + i, copy[1], copy[2], "web") for i in range(30)]
    rows += [(240 + i, f"{copy[1]} {i}", copy[2], "web") for i in range(5)]
    rows += [
        (300, None, None, None),
        (301, "", "ab", "books"),
        (302, " \t\n ", "xy", "code"),
        (303, "12 34 !?", "xy", ""),
        (304, sentence(rng, TONGUES["ab"], 6000), "ab", "books"),
        (5, rows[5][1], "xy", "web"),
        (5, rows[5][1], "xy", "web"),
    ]
    return [(*row, 0.5, 1) for row in rows]


@pytest.fixture(scope="module")
def docs():
    return documents()


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def test_op5_targets_and_bounds(spark, docs, folder, nothing):
    def of(row):
        return len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))

    sizes = Counter()
    for row in docs:
        sizes[row[3]] += of(row)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    targets, open_names, rest = {}, list(names), 1.5 * sum(sizes.values())
    while open_names:
        share = rest / sum(weights[n] for n in open_names)
        over = [n for n in open_names if share * weights[n] > 2 * sizes[n]]
        if not over:
            targets |= {n: share * weights[n] for n in open_names}
            break
        targets |= {n: 2.0 * sizes[n] for n in over}
        rest -= sum(2 * sizes[n] for n in over)
        open_names = [n for n in open_names if n not in over]
    found = queries.op5_mixing(spark, folder).collect()
    known = {row[0]: row for row in docs}
    assert sorted(r.doc_id for r in found) == sorted(row[0] for row in docs)
    taken = Counter()
    for r in found:
        source = known[r.doc_id][3]
        assert (r["size"], r.source_size) == (of(known[r.doc_id]), sizes[source])
        assert r.target == pytest.approx(targets[source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    assert all(abs(taken[n] - targets[n]) <= 2 for n in names)
    assert Counter(found) == Counter(queries.op5_mixing(spark, folder).collect())
    assert queries.op5_mixing(spark, nothing).count() == 0


def test_op6_rows_law(spark, docs, folder, nothing):
    found = queries.op6_sharding(spark, folder).collect()
    held = Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in found)
    own = [(row[0], (row[1] or "").encode()) for row in docs]
    assert held == Counter((i, len(t) + 8, zlib.crc32(t), "rows", None) for i, t in own)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert Counter(found) == Counter(queries.op6_sharding(spark, folder).collect())
    assert queries.op6_sharding(spark, nothing).count() == 0


RULES = {
    "assign": r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}


def base(text):
    spans = []
    for place, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or "", re.ASCII):
            length = len(m[1]) if kind == "assign" else len(m[0])
            if length >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                spans.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}", kind))
    return sorted(spans)


def test_op7_base_and_digest(spark, docs, folder, nothing):
    expected = Counter()
    for row in docs:
        spans = base(row[1])
        counts = Counter(span[3] for span in spans)
        listed = ",".join(span[2] for span in spans)
        digest = sha256(listed.encode()).hexdigest()
        expected[row[0], counts["assign"], counts["access"], counts["hex"], digest] += 1
    found = queries.op7_secrets(spark, folder).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found) == expected
    assert min(sum(r[name] for r in found) for name in ("n_assign", "n_access", "n_hex")) > 0
    known = {row[0]: row[1] for row in docs}
    for r in found:
        spans = r.spans.split(",") if r.spans else []
        assert {span[2] for span in base(known[r.doc_id])} <= set(spans)
        starts = [int(span.split(":")[1]) for span in spans]
        assert starts == sorted(starts)
    assert queries.op7_secrets(spark, nothing).count() == 0


def components(names, linked):
    root = {name: name for name in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {name: find(name) for name in names}


def test_op8_fingerprints_and_components(spark, docs, folder, nothing):
    prints = {}
    for row in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(row[1]))
        parts = [words[i : i + 4] for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64(" ".join(p).encode(), seed=42).intdigest() for p in parts]
        prints[row[0]] = sum(
            1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
        )
    linked = [(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    group = components(sorted(prints), linked)
    expected = Counter((row[0], f"{prints[row[0]]:016x}", group[row[0]]) for row in docs)
    assert Counter(map(tuple, queries.op8_simhash(spark, folder).collect())) == expected
    assert queries.op8_simhash(spark, nothing).count() == 0


def test_op9_removed_bytes(spark, docs, folder, nothing):
    # Rows alike in id and text count as one document.
    values = {(row[0], (row[1] or "").encode()) for row in docs}
    seen = Counter(t[i : i + 200] for _, t in values for i in range(len(t) - 199))
    rows = {}
    for i, t in values:
        gone = [False] * len(t)
        for at in range(len(t) - 199):
            if seen[t[at : at + 200]] > 1:
                gone[at : at + 200] = [True] * 200
        left = bytes(c for c, out in zip(t, gone) if not out)
        runs = sum(out and not (at and gone[at - 1]) for at, out in enumerate(gone))
        rows[i] = (i, len(t), sum(gone), runs, sha256(left).hexdigest())
    expected = Counter(rows[row[0]] for row in docs)
    found = queries.op9_repeats(spark, folder)
    assert Counter(map(tuple, found.collect())) == expected
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sum(r[2] for r in rows.values()) > 1000
    assert queries.op9_repeats(spark, nothing).count() == 0


def held(doc_id, count, remainder):
    return zlib.crc32(str(doc_id).encode()) % count == remainder


def test_op4_learns_nothing_from_held_out_rows(spark, docs, folder, tmp_path):
    found = {r.doc_id: r for r in queries.op4_language(spark, folder).collect()}
    for row in docs:
        r = found[row[0]]
        assert r.held_out == held(row[0], 4, 2) and 0 <= r.score <= 1
        if re.search(r"[^\W\d_]", row[1] or ""):
            assert r.lang_pred in TONGUES
        else:
            assert r.lang_pred == "und"
    unseen = [row for row in docs if row[0] < 120 and held(row[0], 4, 2)]
    right = sum(found[row[0]].lang_pred == row[2] for row in unseen)
    assert len(unseen) > 20 and right >= 0.95 * len(unseen)
    # Other languages and sources on the rows that are held out change no score.
    other = [(*row[:2], "zz", "elsewhere", *row[4:]) if held(row[0], 4, 2) else row for row in docs]
    spark.createDataFrame(other, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    again = {r.doc_id: r for r in queries.op4_language(spark, str(tmp_path)).collect()}
    assert again.keys() == found.keys()
    # Scores are sums of 32-bit floats, whose order depends on how the table is laid out.
    for i, r in found.items():
        assert again[i].lang_pred == r.lang_pred and again[i].score == pytest.approx(r.score, abs=1e-5)


def test_op1_learns_nothing_from_held_out_rows(spark, tmp_path):
    rng = random.Random(23)
    rows = [(i, sentence(rng, (BAD, GOOD)[i % 2], rng.randint(20, 120))) for i in range(200)]
    odd = [(400, None), (401, ""), (402, "!?"), (403, sentence(rng, GOOD, 6000))]
    scores = []
    for turned in (False, True):
        path = f"{tmp_path}/{turned}"
        table = spark.createDataFrame(rows + odd, "doc_id long, text string")
        table = table.withColumn("lang", F.lit("en")).withColumn("source", F.lit("web"))
        table.write.parquet(f"{path}/documents.parquet")
        labels = [(i, (i % 2) ^ (turned and held(i, 5, 0))) for i, _ in rows] + [(999, 1), (None, 0), (7, None)]
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
        scores.append({r.doc_id: r for r in queries.op1_quality(spark, path).collect()})
    found = scores[0]
    assert found.keys() == {row[0] for row in rows + odd}
    for i, r in found.items():
        assert r.held_out == held(i, 5, 0) and 0 <= r.score <= 1
        assert r.predicted == (1 if r.score >= 0.3 else 0)
        assert scores[1][i].score == pytest.approx(r.score, abs=1e-9)
    unseen = [i for i, _ in rows if held(i, 5, 0)]
    assert len(unseen) > 20 and sum(found[i].predicted == i % 2 for i in unseen) >= 0.95 * len(unseen)
    assert found[403].predicted == 1
