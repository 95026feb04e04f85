"""Nulls, empty and very long texts, ties, repeated rows, empty tables, and columns with clashing names."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import cotraining, golay, license_scan, packing, simhash, topk
from holdfast.llm.byte_bpe import byte_bpe, encode, safe_chunks
from holdfast.llm.components import components
from holdfast.llm.language_model import language_model_scores
from holdfast.llm.quality_rules import quality_rules
from holdfast.llm.sharding import shards, write_shards
from holdfast.llm.token_counts import Resynchroniser, token_counts

PIECES, BYTES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, length int, size int, piece int, ids string, "
          "n int, key string, shard int, bucket int, print long, held_out string")
LONG = "lorem ipsum dolor sit amet " * 60_000
TEXTS = [None, "", " \n\t ", "one", "same words here again " * 20, "same words here again " * 20, LONG, "x" * 200_000,
         "äöü 日本語 😀 <|endoftext|> </s>", " ".join(f"w{i}" for i in range(60))]


def rows(texts, first=0):
    extra = (1, 2, 3, "ids", 5, "key", 7, 8, 9, "no")
    return [(first + i, t, None if i == 3 else "en", None if i == 4 else "s", None if i == 5 else 7, *extra)
            for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    data = rows(TEXTS)
    return spark.createDataFrame([*data, data[4], data[4], (None, "no key", *data[0][2:])], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


LABELS = "doc_id long, quality int"

OPERATORS = {
    "token_counts": lambda s, d: token_counts(d, PIECES),
    "packing": lambda s, d: packing.pack(d, BYTES, ids=True),
    "language_model": lambda s, d: language_model_scores(d.withColumn("held_out", d["doc_id"] % 2 == 1), order=3),
    "license_scan": lambda s, d: license_scan.license_scan(d, spans=True),
    "simhash": lambda s, d: simhash.fingerprint_groups(d),
    "one_of_each": lambda s, d: simhash.one_of_each(d),
    "rules": lambda s, d: quality_rules(d),
    "classifier": lambda s, d: cotraining.quality_classifier(d, s.createDataFrame([(1, 1), (2, 0)], LABELS)),
    "shards": lambda s, d: shards(d, 4, bucket_bytes=1 << 16, keep=["doc_id", "text", "size"]).drop("size"),
    "byte_bpe": lambda s, d: byte_bpe(d, RANKS, public_tokenizers.PATTERN, ids=True),
}
PER_ROW = set(OPERATORS) - {"packing", "one_of_each"}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, none, name):
    assert OPERATORS[name](spark, none).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, name):
    out = OPERATORS[name](spark, odd)
    found = out.select(*[c for c in out.columns if out.columns.count(c) == 1]).collect()
    if name in PER_ROW:
        assert len(found) == odd.count()


def test_token_counts_by_chunks():
    made = random.Random(3)
    for chunk, overlap in ((40, 4), (64, 1), (300, 16)):
        counter = Resynchroniser(PIECES, chunk, overlap)
        for _ in range(150):
            letters = made.choice(["ab ", "aeiou   th", "é日本 \n<0x>1", "abcdefghij", "   ", "▁ a😀", "the and of ing "])
            text = "".join(made.choice(letters) for _ in range(made.randint(0, 900)))
            assert counter.counts([text.encode()]) == [len(counter.model.encode(text))]


def test_byte_bpe_by_chunks():
    made = random.Random(4)
    for _ in range(150):
        letters = made.choice(["ab 's", "it's  \n\n we'll 12", "é日本 \u0085\x1c a", "....  a", " \t\n"])
        text = "".join(made.choice(letters) for _ in range(made.randint(0, 400)))
        assert "".join(safe_chunks(text, 20)) == text
        whole, parts = (encode(text, RANKS, public_tokenizers.PATTERN, n) for n in (1 << 20, 20))
        assert whole.tolist() == parts.tolist()


def test_words_are_coded_as_in_whole_texts():
    made, coder = random.Random(5), packing.WordCoder(BYTES)
    for _ in range(300):
        letters = made.choice(["ab 's", "it's  \n\n we'll 12", "é日本  a", "....  aÀÿ×÷", " \t\n\r", "<|endoftext|> a"])
        text = "".join(made.choice(letters) for _ in range(made.randint(0, 200))) + made.choice(["", "<|endoftext|>"])
        assert coder.encode(text) == coder.whole([text])[0]


def best_fit_decreasing(histogram, capacity):
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fit = min((room for room in rooms if room >= length), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((capacity if fit is None else fit) - length)
    return len(rooms)


def test_bins_are_filled():
    made = np.random.default_rng(6)
    for capacity in (10, 64, 2048):
        histogram = {int(k): int(v) for k, v in zip(made.integers(1, capacity + 1, 50), made.integers(1, 400, 50))}
        plan, sequences = packing.minimum_slack(histogram, capacity)
        used = {}
        for length, part in plan.items():
            for number in range(histogram[length]):
                at = np.searchsorted(part.starts, number, side="right") - 1
                used.setdefault(int(part.first[at] + number - part.starts[at]), []).append((int(part.offsets[at]), length))
        assert set(used) == set(range(sequences))
        for places in used.values():
            places.sort()
            assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
            assert sum(n for _, n in places) <= capacity
        assert sequences <= best_fit_decreasing(histogram, capacity)


def test_golay_keys_meet_within_one_error():
    words = np.random.default_rng(7).integers(0, 1 << 23, 3000, dtype=np.uint32)
    keys, numbers = golay.nearby(words)
    assert set(numbers) <= {1, 6}
    for bit in range(23):
        other = golay.nearest(words ^ np.uint32(1 << bit))
        assert ((keys == other[:, None]) & (np.arange(6) < numbers[:, None])).any(1).all()


def test_all_close_fingerprints_are_linked(spark):
    made = np.random.default_rng(8)
    base = made.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = {int(b) for b in base}
    for b in base:
        for _ in range(12):
            flips = made.choice(64, made.integers(1, 6), replace=False)
            prints.add(int(b) ^ sum(1 << int(f) for f in flips))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "print long")).collect()
    mask = (1 << 64) - 1
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}
    assert {tuple(r) for r in links} == expected and len(links) == len(expected)


def test_keys_that_are_looked_up_are_not_broadcast(spark, tmp_path):
    # A small table whose size Spark knows: 20,000 fingerprints, some 1.7 million keys.
    spark.range(20_000).select(F.xxhash64("id").alias("print")).write.parquet(str(tmp_path / "prints"))
    links = simhash.fingerprint_links(spark.read.parquet(str(tmp_path / "prints")))
    links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan


def test_the_near_duplicate_stage_broadcasts_no_keys(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"text {i} of {i * i}") for i in range(300)], "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    seen = []
    monkeypatch.setattr(simhash, "components", lambda links: seen.append(links) or components(links))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    assert corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).count() > 0
    seen[0].collect()
    assert "BroadcastExchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(1001, 1300)]
    cycle = [(2000 + i, 2000 + (i + 7) % 30) for i in range(30)]
    found = {r["node"]: r["root"] for r in components(
        spark.createDataFrame([*chain, *star, *cycle, (5, 5)], "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 1000 for i in range(1000, 1300)},
                     **{2000 + i: 2000 for i in range(30)}}


def plain_first_of_each(rows):
    """Indexes of the rows (key, text) that stay: by all pairs of fingerprints and a search for components."""
    prints = [simhash.fingerprint((t or "").encode(), 3) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and find(i) != find(j):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return [min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0)) for g in groups.values()]


def test_one_of_each_keeps_the_first_of_each_component(spark):
    made, rows = random.Random(9), []
    for i in range(120):
        words = [f"w{made.randrange(4000)}" for _ in range(400)]
        rows.append((3 * i, " ".join(words)))
        for n in range(made.randint(0, 3)):
            words[made.randrange(400)] = f"n{made.random()}"
            rows.append((3 * i + 1000 * (n % 2), " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(105))
    rows += [(10_000 + i, f"{passage} " + " ".join(f"w{made.randrange(10 ** 6)}" for _ in range(45))) for i in range(300)]
    made.shuffle(rows)
    expected = plain_first_of_each(rows)
    data = spark.createDataFrame([(k, t, "d", 1, True) for k, t in rows], "doc_id long, text string, digest string, rows int, kept boolean")
    kept = simhash.one_of_each(data).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(rows[i][0] for i in expected)
    assert 300 < len(kept) < len(rows) and {(r["doc_id"], r["text"]) for r in kept} <= set(rows)


def test_one_of_repeated_rows_stays(spark, odd):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    kept = kept.collect()
    assert [(r["doc_id"], r["source"]) for r in kept if r["text"] == TEXTS[4]] == [(4, None)]
    assert [r["doc_id"] for r in kept if not (r["text"] or "").split()] == [0]
    nameless = spark.createDataFrame([(None, "one"), (None, "one"), (None, "two"), (1, "two")], "doc_id string, text string")
    assert sorted(map(tuple, simhash.one_of_each(nameless).collect()), key=str) == [("1", "two"), (None, "one")]


#: Names of results and inner columns of the stages.
CLASHING = ["kept", "n_words", "base_failed", "_lang", "_source", "_words", "symbols_per_char", "accepted", "p_content", "p_metadata",
            "quality_score", "_chars", "_whole_text", "print", "digest", "row", "rows", "component_id", "fingerprint", "_extra_1",
            "quality", "one", "a", "b", "key", "n_lines", "symbols_per_char_low"]


@pytest.mark.parametrize("stage", ["rules", "classifier", "near_duplicates", "packed"])
def test_stages_keep_columns_of_any_name(spark, stage):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    run = getattr(corpus_pipeline, stage)
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("text", F.when(F.col("doc_id") % 50 != 7, F.col("text")))
    docs = docs.unionAll(docs.where("doc_id in (3, 4)"))
    wide = docs.select(*[F.lit(i).alias(c) for i, c in enumerate(CLASHING)], *docs.columns)
    plain, clashing = run(spark, docs, folder), run(spark, wide, folder)
    if stage != "packed":
        assert clashing.columns == wide.columns and plain.columns == docs.columns
        values = {tuple(r)[:len(CLASHING)] for r in clashing.collect()}
        assert values == {tuple(range(len(CLASHING)))}
    order = lambda frame: sorted((tuple(r) for r in frame.select(plain.columns).collect()), key=str)
    assert order(plain) == order(clashing)
    assert run(spark, wide.limit(0), folder).collect() == []


def test_templates():
    scan = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES).scan
    labels = lambda text: scan(text.encode())[5]
    assert labels("Licensed under the APACHE license, 2.0") == "apache-2.0"
    assert labels("Licensed under the Apache Licence, Version 2.0") == ""
    assert labels("This small program is licensed under the General Public License, version 3") == "gpl,gpl-notice"
    assert labels("This one is not licensed by the General Public License") == "gpl"
    assert labels("Copyright (c) 2020 Some Body. All rights reserved") == "copyright,reserved"
    assert scan(b"cc by cc by")[1:4] == (2, 0, 2)
    with pytest.raises(ValueError):
        license_scan.Scanner({}, {"x": '<<var;match=".+";words=2>> license'})


def as_expression(template):
    """The template as a regular expression over its words, each followed by a space."""
    out = ""
    for part in re.split("(<<.*?>>)", template, flags=re.S):
        if found := re.fullmatch('<<var;match="(.*)";words=(.*)>>', part):
            out += "(?:(?:%s) ){1,%s}" % ("[^ ]+" if found[1] == ".+" else found[1], found[2])
        elif part.startswith("<<"):
            out += "(?:" if part == "<<beginOptional>>" else ")?"
        else:
            out += "".join(re.escape(w) + " " for w in re.findall("[a-z0-9]+", part.lower()))
    return re.compile(out)


def written(template, made):
    """A text that the template accepts, as words."""
    out, dropped = [], []
    for part in re.split("(<<.*?>>)", template, flags=re.S):
        if part == "<<beginOptional>>":
            dropped.append(made.random() < 0.5)
        elif part == "<<endOptional>>":
            dropped.pop()
        elif any(dropped):
            continue
        elif found := re.fullmatch('<<var;match="(.*)";words=(.*)>>', part):
            made_up = {".+": ["the", "authors", "acme"], "[0-9]+": ["2", "30"], "[0-9]{4}": ["1999", "2024"]}[found[1]]
            out += [made.choice(made_up) for _ in range(made.randint(1, int(found[2])))]
        else:
            out += re.findall("[a-z0-9]+", part.lower())
    return out


@pytest.mark.parametrize("label", license_scan.TEMPLATES)
def test_automata_accept_what_expressions_do(label):
    """Accepted texts, and texts with a word changed, left out, doubled or moved, against a regular expression."""
    template, made = license_scan.TEMPLATES[label], random.Random(label)
    automaton, expression = license_scan.compiled(template), as_expression(template)
    verdicts = Counter()
    for turn in range(120):
        words = written(template, made)
        assert automaton.run([w.encode() for w in words], 0) == len(words)
        at = made.randrange(len(words))
        changed = made.choice([words[:at] + ["other"] + words[at + 1:], words[:at] + words[at + 1:], words[:at] + words[at:at + 1] * 2
                               + words[at + 1:], words[at:] + words[:at], words[:at] + ["7"] + words[at:]])
        got = automaton.run([w.encode() for w in changed] + [b"end"], 0) if changed else None
        want = max((i for i in range(1, len(changed) + 2) if expression.fullmatch(
            "".join(w + " " for w in [*changed, "end"][:i]))), default=None)
        assert got == want, changed
        verdicts[got is None] += 1
    assert verdicts[True] > 20


def test_whole_license_texts():
    scan = license_scan.Scanner(license_scan.PHRASES, license_scan.TEMPLATES).scan
    made = random.Random(8)
    for label, template in license_scan.TEXTS.items():
        text = "A file. " + " ".join(written(template, made)) + " End of it."
        found = scan(text.encode())
        assert label in found[5].split(",") and found[6] > 0.5
    assert "cc-by-notice" not in scan(b"This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License")[5].split(",")


def test_texts_without_any_statement(spark):
    data = spark.createDataFrame([(i, "no statement here") for i in range(5)], "doc_id long, text string").coalesce(1)
    found = license_scan.license_scan(data, spans=True).collect()
    assert all(r["first_word"] is None and r["spans"] == [] and r["n_words"] == 3 for r in found) and len(found) == 5


@pytest.mark.parametrize("groups", [(8, 64), (1, 1), (3, 2)])
def test_top_k_with_ties_copies_and_bad_vectors(spark, groups):
    made = np.random.default_rng(10)
    data = [(i, [float(x) for x in made.integers(-3, 4, 6) / 1024]) for i in range(300)]
    data += [(7, data[7][1]), (200, data[200][1]), (None, data[1][1]), (900, None), (901, [1.0, None] + [0.0] * 4),
             (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [1.0, 2.0]), (300, [0.5, 0.5])]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    found = topk.top_k(vectors, k=5, block_rows=32, query_rows=2, step=2, group_blocks=groups[0], group_queries=groups[1]).collect()
    usable = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in data
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for at, (i, q) in enumerate(usable):
        if i % 100 == 0:
            others = sorted((-int(q @ v), j) for n, (j, v) in enumerate(usable) if n != at and len(v) == len(q))
            expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(others[:5])]
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_shards_are_whole_even_and_written(spark, odd, tmp_path):
    out = shards(odd, 4, bucket_bytes=1 << 16, keep=["doc_id", "text"]).collect()
    sizes = [sum(r["shard"] == s for r in out) for s in range(4)]
    assert sum(sizes) == odd.count() and max(sizes) - min(sizes) <= 1
    write_shards(odd.select("doc_id", "text"), str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd.count()


def test_shards_are_written_where_they_are_shuffled(spark, tmp_path):
    """Runs of buckets: one order without gaps, files of a shard in its order, and few of them."""
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.pmod(F.col("id"), F.lit(50)).cast("int")).alias("text"))
    placed = shards(docs, 7, bucket_bytes=1 << 10)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Union")[0]
    assert "Join" not in above and above.count("Exchange") == 1
    tasks = placed.rdd.getNumPartitions()
    assert 8 < tasks <= 30  # of some 240 buckets
    write_shards(docs, str(tmp_path / "out"), 7, bucket_bytes=1 << 10)
    want = {s: [] for s in range(7)}
    for r in placed.select("doc_id", "shard", "slot").orderBy("shard", "slot").collect():
        assert r["slot"] == len(want[r["shard"]])
        want[r["shard"]].append(r["doc_id"])
    assert sorted(i for own in want.values() for i in own) == list(range(6000))
    assert {len(own) for own in want.values()} == {857, 858}
    assert want[0][:50] != sorted(want[0][:50])
    total = 0
    for shard, ids in want.items():
        files = sorted((tmp_path / "out" / f"shard={shard}").glob("*.parquet"))
        read = pa.concat_tables([pq.ParquetFile(f).read() for f in files])
        assert read["slot"].to_pylist() == list(range(len(ids)))
        total += len(files)
    assert total <= tasks + 7


def test_rules_follow_each_group(spark):
    plain = [(i, " ".join(f"w{(i * 31 + j * j) % 997}" for j in range(80)), "en", "plain") for i in range(150)]
    marked = [(1000 + i, " ".join(f"w{(i * 17 + j * j) % 991}#" for j in range(80)), "en", "marked") for i in range(150)]
    odd = [(5000, marked[3][1], "en", "plain")]
    data = spark.createDataFrame(plain + marked + odd, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(data).collect()}
    assert not kept.pop(5000) and all(kept.values())


def test_language_model_in_small_blocks(spark):
    texts = ["the cat sat", "the cat ran", "a dog sat", None, "", "The CAT sat on the mat", "zebra"] * 5
    data = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    key = lambda r: r["doc_id"]
    one = sorted(language_model_scores(data.coalesce(1), order=3).collect(), key=key)
    many = sorted(language_model_scores(data.repartition(5), order=3, block_bytes=20, part_bytes=64).collect(), key=key)
    for a, b in zip(one, many, strict=True):
        assert a["score"] == pytest.approx(b["score"]) and a["n_known"] == b["n_known"]
    known = {r["doc_id"]: r for r in one}
    assert known[1]["score"] > known[1]["base_score"]


def test_language_model_blocks_are_bounded_by_tokens(spark):
    """Short frequent words fill a block by tokens long before its bytes: memory follows the tokens."""
    from holdfast.llm.language_model import blocks

    texts = ["a " * 30, "a b a b a b", "a", "b a b"] * 10
    data = spark.createDataFrame([(i, t, i % 4 == 1) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    made = blocks(data.coalesce(1), block_bytes=1 << 20, block_tokens=16).collect()
    # A block closes with the text that reaches the bound; one text may pass it alone.
    assert len(made) > 1 and all(r["n_tokens"] - r["lengths"][-1] < 16 for r in made)
    key = lambda r: r["doc_id"]
    whole = sorted(language_model_scores(data.coalesce(1), order=2, block_tokens=1 << 20).collect(), key=key)
    small = sorted(language_model_scores(data.coalesce(1), order=2, block_tokens=16).collect(), key=key)
    for a, b in zip(whole, small, strict=True):
        assert a["score"] == pytest.approx(b["score"]) and a["n_known"] == b["n_known"]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_language_model_walk_is_the_closed_formula(spark, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randrange(0, 40))) for _ in range(60)] + ["a b unseen a b", "unseen", "", "a a a a a a"]
    held = [i % 4 == 1 or i >= 60 for i in range(len(texts))]
    grams, histories = Counter(), Counter()
    for text, out in zip(texts, held):
        own = ["<", *text.split(), ">"]
        for i in range(1, 0 if out else len(own)):
            for size in range(1, min(order, i + 1) + 1):
                gram = tuple(own[i - size + 1:i + 1])
                grams[gram] += 1
                histories[gram[:-1]] += 1
    total, kinds = histories[()], sum(len(g) == 1 for g in grams)

    def p(history, token):
        if not history:
            return (grams[(token,)] + 0.5) / (total + 0.5 * (kinds + 1))
        lower = p(history[1:], token)
        return (grams[(*history, token)] + 3 * lower) / (histories[history] + 3) if histories[history] else lower

    data = spark.createDataFrame(list(zip(range(len(texts)), texts, held)), "doc_id long, text string, held_out boolean")
    got = {r["doc_id"]: r for r in language_model_scores(data.repartition(3), order=order, mass=3.0, block_bytes=300).collect()}
    for i, text in enumerate(texts):
        own = ["<", *text.split(), ">"]
        want = sum(math.log10(p(tuple(own[max(0, j - order + 1):j]), own[j])) for j in range(1, len(own)))
        assert got[i]["score"] == pytest.approx(want), text


def test_classifier_without_both_classes_accepts_all(spark, odd):
    labels = spark.createDataFrame([(1, 1)], LABELS)
    assert all(r["accepted"] for r in cotraining.quality_classifier(odd, labels).collect())


def pool_of(spark, made, size, labelled=400):
    """Documents of two kinds that both views tell apart with errors, and labels of the first ones."""
    data, labels = [], []
    for i in range(labelled + size):
        good = made.random() < 0.7
        words = made.choice(["plain", "words", "of", "some", "prose"] if made.random() < 0.9 and good else ["$$$", "WIN", "!!"], 40)
        source = made.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1] if good else [0.1, 0.2, 0.7])
        data.append((i, " ".join(words), "en", str(source), int(made.integers(100, 900) if good else made.integers(10, 300))))
        if i < labelled:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    return docs, spark.createDataFrame(labels, LABELS)


def plain_cotraining(ids, quality, views, rounds):
    """Co-training of arrays in memory, with whole rankings."""
    held = cotraining.held_back(ids, np.where(quality < 0, 1, quality)) & (quality >= 0)
    train, pool, taught = (quality >= 0) & ~held, np.flatnonzero(quality < 0), [{}, {}]
    rate = quality[train].mean()

    def fitted(v):
        at = [*np.flatnonzero(train), *taught[v]]
        return cotraining.fit(views[v][at], np.array([*quality[train], *taught[v].values()], dtype=float))

    for _ in range(rounds):
        models, given = (fitted(0), fitted(1)), [{}, {}]
        for v in (0, 1):
            left = [i for i in pool if i not in taught[1 - v]]
            margin = dict(zip(left, models[v].margin(views[v][left])))
            ranked, most = sorted(left, key=margin.get), int(len(pool) * cotraining.TAUGHT_SHARE)
            bad, good = int(most * (1 - rate)), int(most * rate)
            # What ties with the last one goes with it.
            given[1 - v] = {i: 0 for i in left if bad and margin[i] <= min(margin[ranked[bad - 1]], -np.log(9))}
            given[1 - v] |= {i: 1 for i in left if good and margin[i] >= max(margin[ranked[-good]], np.log(9))}
        for v in (0, 1):
            taught[v] |= given[v]
    return fitted(0), fitted(1), taught


def test_cotraining_in_spark_is_that_of_the_whole_pool(spark, monkeypatch):
    docs, labels = pool_of(spark, np.random.default_rng(3), 2000)
    stored = cotraining.stored_features(docs, labels)
    found = stored.toArrow().sort_by("doc_id")
    ids, quality = found["doc_id"].to_pylist(), np.asarray(found["quality"])
    assert len(ids) == 2400 and (quality >= 0).sum() == 400
    content, meta, taught = plain_cotraining(ids, quality, cotraining._whole(found), 3)
    drawn, draw = [], cotraining._taught
    monkeypatch.setattr(cotraining, "_taught", lambda *a: drawn.append(draw(*a)) or drawn[-1])
    got = cotraining.cotrain(stored, rounds=3)
    assert [sum(t[v] for t, _ in drawn) for v in (0, 1)] == [len(taught[1]), len(taught[0])]
    assert all(min(t) > 0 for t, _ in drawn)
    for a, b in ((content, got.content), (meta, got.metadata)):
        assert np.allclose(a.weights, b.weights, rtol=1e-5, atol=1e-6)


def test_a_rare_source_teaches_and_what_is_fitted_on_is_bounded(spark, monkeypatch):
    docs, labels = pool_of(spark, np.random.default_rng(4), 4000)
    rare = spark.createDataFrame(
        [(10_000 + i, "plain words of some prose " * 8, "en", "rare", 800) for i in range(12)], docs.schema)
    stored, drawn, draw = cotraining.stored_features(docs.union(rare), labels), [], cotraining._taught
    monkeypatch.setattr(cotraining, "_taught", lambda *a: drawn.append(draw(*a)) or drawn[-1])
    # Every sure document is handed over: thousands, of which some 80 are drawn, 14 good ones of each source.
    monkeypatch.setattr(cotraining, "ranks", lambda pool, left, rate: (left // 2, left // 2))
    assert cotraining.cotrain(stored, rounds=2, most_taught=80) is not None
    assert max(len(y) for _, d in drawn for _, y in d) <= 160 and drawn[0][0][0] > 1500
    place = 16 + int(cotraining.places(["en"], ["rare"])[1][0])
    assert sum(d[0][0][:, place].sum() for _, d in drawn if len(d[0][1])) == 12


def test_levels_share_out():
    assert cotraining.level([5, 100, 100], 45) == 20
    assert cotraining.level([5, 6], 45) == 6
    assert cotraining.level([], 45) == 0
    assert cotraining.level([10, 10], 10) == 5


def test_columns_called_like_results(spark):
    """Every column that the rules and the classifier read or make inside is an input column as well."""
    docs, labels = pool_of(spark, np.random.default_rng(5), 300)
    longer = F.concat_ws(" ", "text", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), i)))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 7 > 0, longer).otherwise(F.col("text")))
    names = ["kept", "n_words", "word_chars", "n_lines", "base_failed", "symbols_per_char", "_words", "_at", "_lang", "_source",
             "lang_rows", "symbols_per_char_low", "accepted", "p_content", "p_metadata", "quality_score", "_whole_text", "_l",
             "quality", "content", "src", "given0", "margin0", "view", "rank", "c0", "rows", "one"]
    more = docs.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    for operator, key in ((lambda d: quality_rules(d, group_rows=20), "kept"),
                          (lambda d: cotraining.quality_classifier(d, labels), "accepted")):
        plain, got = ({r["doc_id"]: r for r in operator(d).collect()} for d in (docs, more))
        assert len(got) == 700 and len(set(got[0].__fields__)) == len(got[0].__fields__)
        made = [c for c in plain[0].__fields__ if c not in docs.columns]
        assert key in made and len({r[key] for r in plain.values()}) == 2
        for i, r in got.items():
            assert [r[c] for c in plain[0].__fields__] == [plain[i][c] for c in plain[0].__fields__]
            assert all(r[c] == f"own {c}" for c in names if c not in made)
