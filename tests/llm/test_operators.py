"""The text operators on small tables, against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontamination, passages, repeats, secrets, sentences, simhash
from tidemark.llm.common import first_by_hash
from tidemark.llm.language import fit_language, with_language
from tidemark.llm.mixing import mix, word_count
from tidemark.llm.neighbours import nearest
from tidemark.llm.quality import fit_quality, with_quality
from tidemark.llm.sharding import permuted, shard_rows

DOCS = "doc_id long, text string, lang string, source string, _row string, score int"
LONG = "the of and " * 5000
EDGES = [
    (1, None, None, None, "x", 1),
    (2, "", "en", "a", "x", 1),
    (3, LONG, "en", "a", "x", 1),
    (4, "one two three.", "en", "b", None, None),
    (4, "one two three.", "en", "b", None, None),
    (None, "one two three.", None, None, "y", 2),
    (5, "é ü 12 . . .", "fr", "c", "y", 2),
    (6, "12 34 !?", "fr", None, "y", 2),
]
ITEMS = "item_id long, text string, text_ int"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(EDGES, DOCS)


def random_text(rng, vocabulary, most):
    return " ".join(rng.choices(vocabulary, k=rng.randint(0, most)))


def test_decontamination_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        vocabulary = "abc"[: rng.randint(1, 3)]
        sizes = [0, 1, 2, 5, 12, 13, 14, 30]
        items = [
            (str(k), rng.choices(vocabulary, k=rng.choice(sizes))) for k in range(rng.randint(0, 4))
        ]
        text = rng.choices(vocabulary + "d", k=rng.randint(0, 40))
        text += [w for _, words in items if rng.random() < 0.5 for w in words[rng.randint(0, 2) :]]
        automaton = decontamination.built([(k, w, len(w) < 13) for k, w in items])
        spans, found = decontamination.matched(text, automaton)
        hit, names = set(), set()
        for name, words in items:
            n = min(13, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                for j in range(len(text) - n + 1):
                    if text[j : j + n] == words[i : i + n]:
                        names.add(name)
                        hit |= set(range(j, j + n))
        assert {k for a, b in spans for k in range(a, b)} == hit and found == names


def test_decontamination_in_blocks(spark, docs):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(6)]
    rows = [(i, random_text(rng, vocabulary, 60), 0) for i in range(20)]
    rows += [(30, None, 0), (31, "", 1), (None, "one two", 2), (None, "one two", 2)]
    items = spark.createDataFrame(rows, ITEMS)
    texts = spark.createDataFrame(
        [(i, random_text(rng, vocabulary, 80), "en", "s", "", 0) for i in range(20)], DOCS
    ).unionByName(docs)
    whole = decontamination.with_contamination(texts, items, out="score")
    cut = decontamination.with_contamination(
        texts, items, out="score", piece_words=20, block_words=100
    )
    assert whole.columns == ["doc_id", "text", "lang", "source", "_row", "score"]
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
    none = decontamination.with_contamination(texts, items.limit(0), out="f")
    assert none.where(F.size("f.spans") > 0).count() == 0
    assert decontamination.with_contamination(texts.limit(0), items).count() == 0


BASE = [
    re.compile(
        r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
        r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)"
    ),
    re.compile("(AKIA[A-Z0-9]+)"),
    re.compile("([0-9a-f]+)"),
]


def base_spans(text):
    spans = []
    for k, (rule, least) in enumerate(zip(BASE, (12, 18, 16))):
        spans += [(m.start(), k, m.end()) for m in rule.finditer(text) if len(m[1]) >= least]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(spans)]


def test_secrets_equal_regexes():
    rng = random.Random(3)
    parts = ["token", "secret", "api_key", "PASSWORD", ":", "=", " ", '"', "'", "abc", "A" * 12]
    parts += ["deadbeef", "0123456789abcdef", "AKIA", "Z9", "é", "\n", "a"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert [s[:3] for s in secrets.found(text) if s[3]] == base_spans(text), text
    hidden = [s for s in secrets.found("secret=token: abcdefghijklmnop") if not s[3]]
    assert hidden == [("assign", 7, 30, False)]


def test_secrets_of_odd_texts(spark, docs):
    found = docs.select(F.size(secrets.secret_spans(F.col("text"))).alias("n"))
    assert [row.n for row in found.collect()] == [0] * len(EDGES)


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for text in (None, "", "A b", "a  B\tc d\x0be", "x y z " * 50):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles] if words else []
        bits = [sum(h >> k & 1 for h in hashes) * 2 > len(hashes) for k in range(64)]
        assert simhash.fingerprint(text, 4) == sum(1 << k for k in range(64) if bits[k])


@pytest.mark.parametrize("subtree", [4, 100_000])
def test_near_groups_equal_brute_force(spark, subtree, monkeypatch):
    monkeypatch.setattr(simhash, "SUBTREE", subtree)
    monkeypatch.setattr(simhash.near_links, "__defaults__", (subtree,))
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**62, 12, dtype=np.uint64)[rng.integers(0, 12, 150)]
    for _ in range(5):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    ids = [int(i) for i in rng.permutation(150)]
    frame = spark.createDataFrame(
        list(zip(ids, prints.view(np.int64).tolist())), "doc_id long, p long"
    )
    a, b = np.nonzero(np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4, 1))
    labels = simhash._union(np.arange(150), a, b)
    least = {k: min(ids[i] for i in np.flatnonzero(labels == k)) for k in set(labels.tolist())}
    found = {r.doc_id: r["_group"] for r in simhash.near_groups(frame, "doc_id", "p").collect()}
    assert found == {ids[i]: least[labels[i]] for i in range(150)}
    assert simhash.near_groups(frame.limit(0), "doc_id", "p").count() == 0


def test_repeated_bytes_equal_brute_force(spark):
    rng = random.Random(5)
    pool = ["".join(rng.choices("abcdef é", k=400)) for _ in range(3)] + ["ab" * 150, "x" * 300]
    rows = []
    for i in range(25):
        text = ""
        for _ in range(rng.randint(1, 3)):
            part = rng.choice(pool)
            start = rng.randint(0, len(part))
            text += part[start : rng.randint(start, len(part))] + random_text(rng, "xyz", 9)
        rows.append((i, text, "", "", "", 0))
    rows += [(90, None, "", "", "", 0), (91, "", "", "", "", 0), rows[0], (None, "q" * 250, "", "", "", 0)]
    frame = spark.createDataFrame(rows, DOCS)
    texts = [(row[1] or "").encode() for row in rows]
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    expected = []
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - 199):
            if count[text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        expected.append(bytes(b for b, g in zip(text, gone) if not g))
    cut = repeats.without_repeated_bytes(frame, out="score")
    assert sorted(bytes(r.score.kept) for r in cut.collect()) == sorted(expected)
    split = repeats.without_repeated_bytes(frame, out="score", most=1)
    assert sorted(bytes(r.score.kept) for r in split.collect()) == sorted(expected)
    assert repeats.without_repeated_bytes(frame.limit(0)).count() == 0


def test_repeated_rows_do_not_use_up_a_sample(spark):
    rows = spark.range(5000).selectExpr("id % 2 as g", "if(id < 4000, id % 2, id) as k")
    first = first_by_hash(rows.withColumn("_rank", F.lit(1)), "g", "k", 100)
    found = Counter(r.g for r in first.collect())
    assert found == {0: 100, 1: 100} and first.distinct().count() == 200
    hashed = rows.where("g = 1").distinct().orderBy(F.xxhash64("k"), "k").limit(100)
    assert {r.k for r in hashed.collect()} == {r.k for r in first.where("g = 1").collect()}
    assert first_by_hash(rows.limit(0), "g", "k", 3).count() == 0


def test_a_line_that_is_everywhere_is_split(spark):
    """Texts around one line of 150 bytes have one anchor; some share a neighbour of the line."""
    rng = random.Random(6)
    line = "".join(rng.choices("abcdefgh", k=150))
    sides = ["".join(rng.choices("ijklmnop", k=120)) for _ in range(60)]
    rows = [(i, sides[i] + line + sides[i - i % 7], "", "", "", 0) for i in range(60)]
    rows += [(100 + i, sides[i][-30:] + line + sides[i][:25], "", "", "", 0) for i in range(60)]
    texts = [row[1].encode() for row in rows]
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    expected = []
    for row, text in zip(rows, texts):
        gone = {k for i in range(len(text) - 199) if count[text[i : i + 200]] > 1 for k in range(i, i + 200)}
        expected.append((row[0], bytes(b for k, b in enumerate(text) if k not in gone)))
    assert any(len(kept) < len(text) for (_, kept), text in zip(expected, texts))
    for most in (3, 50, repeats.LOT):
        cut = repeats.without_repeated_bytes(spark.createDataFrame(rows, DOCS), out="out", most=most)
        assert sorted((r.doc_id, bytes(r.out.kept)) for r in cut.collect()) == expected


def test_repeated_sentences(spark, docs):
    passage = "Alpha beta gamma delta epsilon. Zeta eta theta iota kappa! Lambda mu nu xi omicron?"
    rows = [
        (1, f"First own words. {passage} End one.", "", "", "", 0),
        (2, f"Other own words. {passage} End two.", "", "", "", 0),
        (3, f"{passage}\n{passage}", "", "", "", 0),
    ]
    cut = sentences.without_repeats(spark.createDataFrame(rows, DOCS), out="out")
    kept = {row.doc_id: row.out.kept.strip() for row in cut.collect()}
    assert kept[1] == rows[0][1] and kept[2] == "Other own words. End two." and kept[3] == ""
    odd = {r.doc_id: r.out for r in sentences.without_repeats(docs, out="out").collect()}
    assert odd[1].kept is None and odd[2].kept == "" and odd[4].kept == ""
    assert odd[None].kept == "one two three."
    assert sentences.without_repeats(docs.limit(0)).count() == 0


def test_repeated_passages_without_sentences(spark, docs):
    rng = random.Random(11)
    vocabulary = [a + b + c for a in "bdklmn" for b in "aeiou" for c in "rstz"]
    chinese = [chr(0x4E00 + i) for i in range(3000)]
    own = lambda words=vocabulary, k=30: rng.choices(words, k=k)
    shared = [own(k=50), [w + "." * (i % 17 == 9) for i, w in enumerate(own(k=50))]]
    shared += [own(chinese, 50), ["word", "word", "and"] * 17]
    rows = []
    for i, passage in enumerate(shared):
        around = chinese if i == 2 else vocabulary
        space = "" if i == 2 else " "
        for k in range(3):
            middle = passage if k < 2 else [w + "\n" * (i != 2) for w in passage]
            text = space.join(own(around)) + space + space.join(middle) + space
            rows.append((10 * i + k, text + space.join(own(around)), "", "", "", 0))
    frame = spark.createDataFrame(rows, DOCS)

    def longest(a, b):
        most, last = 0, [0] * (len(b) + 1)
        for x in a:
            last = [0] + [last[j] + 1 if x == y else 0 for j, y in enumerate(b)]
            most = max(most, *last)
        return most

    def cut(text):
        return list(text) if "一" <= text[0] <= "鿿" else text.split()

    made = passages.without_passages(frame, out="out").collect()
    kept = {row.doc_id: cut(row.out.kept) for row in made}
    for i in range(len(shared)):
        # The last passage repeats within itself.
        assert i == 3 or kept[10 * i] == cut(rows[3 * i][1])
        for a, b in ((0, 1), (0, 2), (1, 2)):
            assert longest(kept[10 * i + a], kept[10 * i + b]) < 20
        assert min(len(kept[10 * i + k]) for k in (1, 2)) >= 60
    odd = {r.doc_id: r.out for r in passages.without_passages(docs, out="out").collect()}
    assert odd[1].kept is None and odd[2].kept == "" and odd[4].kept == ""
    assert odd[None].kept == "one two three."
    assert passages.without_passages(docs.limit(0)).count() == 0


def test_language_and_quality(spark, docs):
    rng = random.Random(6)
    english, german = ["the", "house", "with", "green"], ["und", "größe", "straße", "nicht"]
    rows = [
        (i, random_text(rng, (english, german)[i % 2], 30) + " x", ("en", "de")[i % 2], "s", "", 0)
        for i in range(80)
    ]
    frame = spark.createDataFrame(rows, DOCS)
    model = fit_language(frame.where("doc_id < 60"))
    marked = with_language(frame.unionByName(docs), model, out="score").collect()
    # ids 1 to 6 are also those of the odd texts
    wrong = [r for r in marked if r.doc_id and r.doc_id > 6 and r.score.lang != r.lang]
    assert len(wrong) <= 2 and all(0 <= r.score.score <= 1 for r in marked)
    odd = [r.score.lang for r in marked if r.text in (None, "", "12 34 !?")]
    assert odd == ["und"] * 3
    empty = with_language(docs, fit_language(docs.limit(0)))
    assert {r.language.lang for r in empty.collect()} == {"und"}

    bad = [(100 + i, "A!! B!! " * (10 + i), "en", "s", "", 0) for i in range(40)]
    frame = frame.unionByName(spark.createDataFrame(bad, DOCS))
    labels = spark.createDataFrame(
        [(r[0], 1) for r in rows] + [(r[0], 0) for r in bad] + [(None, 1), (7, None), (999, 1)],
        "doc_id long, quality int",
    )
    quality = fit_quality(frame, labels, "quality")
    scored = with_quality(frame.unionByName(docs), quality, out="score").collect()
    assert all((r.score.score > 0.5) == (r.doc_id < 100) for r in scored if (r.doc_id or 0) > 6)
    assert all(abs(sum(r.score.attention) - 1) < 1e-4 and 0 <= r.score.score <= 1 for r in scored)
    untaught = with_quality(docs, fit_quality(docs, labels.limit(0), "quality")).collect()
    assert {round(r.quality.score, 6) for r in untaught} == {0.5}


def test_texts_of_no_learned_language_are_rejected(spark):
    rng = random.Random(10)
    english = "the house with green of and that this people water light morning could".split()
    german = "und größe straße nicht der die das wasser leute morgen licht könnte haus".split()
    rows = [
        (i, random_text(rng, (english, german)[i % 2], 40) + " x", ("en", "de")[i % 2], "s", "", 0)
        for i in range(200)
    ]
    consonants = " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=6)) for _ in range(60))
    strange = ["Это простой текст на русском языке о погоде", "这是一个简单的中文文本", consonants]
    rows += [(1000 + i, text, None, "s", "", 0) for i, text in enumerate(strange)]
    kept = corpus_pipeline.language(spark, spark.createDataFrame(rows, DOCS), "").collect()
    ids = {row.doc_id for row in kept}
    assert not ids & {1000, 1001, 1002} and len(ids) >= 195


def test_nearest_recalls_nine_tenths(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(900, 24))
    vectors[300:600] = vectors[rng.integers(0, 20, 300)] + rng.normal(size=(300, 24)) * 0.05
    vectors[600:650] = vectors[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    odd = [(1000, None, 0), (1050, [0.0] * 24, 0), (1100, [float("nan")] * 24, 0), (None, [1.0] * 24, 0)]
    odd += [(1150, [1.0, None] + [0.0] * 22, 0), (1200, [1.0], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score int")
    found = nearest(frame, F.col("vec_id") % 50 == 0).collect()
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 900, 50):
        scores = (units * units[q]).sum(axis=1)
        scores[q] = -9
        best = np.lexsort((np.arange(900), -scores.round(12)))[:5]
        own = sorted((r["rank"], r.vec_id) for r in found if r.query_id == q)
        assert [rank for rank, _ in own] == [1, 2, 3, 4, 5]
        hits += len({v for _, v in own} & set(best.tolist()))
    assert hits >= 0.9 * 90 and len(found) == 90
    assert nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = frame.where("vec_id < 3")
    assert nearest(few, F.col("vec_id") == 0).count() == 2


def mixed(docs):
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        word_count(F.col("text")).alias("_size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_check"),
    )
    return rows, mix(rows, block=16)


def test_mix_meets_its_targets(spark, docs):
    rng = random.Random(8)
    rows = [
        (i, random_text(rng, "ab", 40), "en", "big" if i % 3 else f"s{i % 7}", "", 0)
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, DOCS).unionByName(docs)
    sized, found = mixed(frame)
    sizes = {r["_row"]: r for r in sized.collect()}
    taken, per_source = Counter(), Counter()
    for piece in found.pieces.collect():
        own = sizes[piece["_row"]]
        assert 0 <= piece["_from"] and piece["_from"] + piece["_words"] <= own["_size"]
        taken[piece["_row"]] += piece["_words"]
        per_source[own["_source"]] += piece["_words"]
    assert all(taken[k] <= 2 * r["_size"] for k, r in sizes.items())
    total = 0
    for source in found.sources.collect():
        assert abs(per_source[source["_source"]] - source["_target"]) <= 0.5
        assert source["_target"] <= 2 * source["_size"] + 1e-6
        total += source["_target"]
    assert total == pytest.approx(1.5 * sum(r["_size"] for r in sizes.values()))
    _, none = mixed(frame.limit(0))
    assert none.pieces.count() == 0


def test_shards_are_even_and_reproducible(spark, docs):
    for size in (1, 2, 3, 10, 97, 100):
        numbers = spark.range(size).select(permuted(F.col("id"), size, 1).alias("n")).collect()
        assert sorted(r.n for r in numbers) == list(range(size))
    frame = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("shard"))
    key = [F.col("doc_id")]
    found = shard_rows(frame, key, 24)
    assert found.columns == ["doc_id", "shard", "slot"]
    rows = sorted(found.collect())
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 24
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert sorted(shard_rows(frame.repartition(7), key, 24).collect()) == rows
    assert shard_rows(docs, [F.col("doc_id"), F.col("text")], 3).count() == len(EDGES)
    assert shard_rows(frame.limit(0), key, 24).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    rng = random.Random(9)
    vocabulary = [f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    item = " ".join(rng.choices(vocabulary, k=20))
    rows = [
        (100 + i, random_text(rng, vocabulary, 60) + " end", "en", f"s{i % 3}", "", 0)
        for i in range(40)
    ]
    rows += [(200, rows[5][1], "en", "s1", "", 0), (201, item, "en", "s1", "", 0)]
    spark.createDataFrame(rows, DOCS).unionByName(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item, 0)], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = frame.columns
    before = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, str(tmp_path))
        assert after.columns == names, name
        after.write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
    ids = {
        name: {r.doc_id for r in spark.read.parquet(f"{tmp_path}/{name}").collect()}
        for name, _ in corpus_pipeline.STAGES[:-1]
    }
    assert {100, 201} <= ids["language"] and not {1, 2, 6} & ids["language"]
    assert 200 not in ids["near_duplicates"] and 105 in ids["near_duplicates"]
    assert ids["near_duplicates"] - ids["decontamination"] == {201}
    last = corpus_pipeline.STAGES[-1][1](spark, before, str(tmp_path))
    assert last.columns == [*names, "shard", "slot"] and last.count() == before.count()
    empty = frame.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0

