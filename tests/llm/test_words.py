"""Spelling variants, SentencePiece with spans, and periodic runs: each against a plain version, and odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from holdfast.llm import sentence_pieces as pieces
from holdfast.llm import spelling
from holdfast.llm.catalog import QUERIES, slip
from holdfast.llm.periodic_runs import collapse, periodic_runs, periodic_runs_of, runs_of, strongest

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ("doc_id long, text string, word string, n long, form string, near string, key string, _key string, n_tokens string, "
       "n_runs string, start int, period int, ids string, _whole_text string, cell int, hash long, root int")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def odd_rows(texts):
    return [(i, t, "x", 1, "x", "x", "k", "k", "t", "r", 1, 2, "i", "w", 3, 4, 5) for i, t in texts]


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Spelling variants


def plain_groups(counts, ratio=10):
    """word -> (form, root, n, n_near, form_n), by looking up every edit of every word."""
    letters, out = sorted(set("".join(counts))), {}
    for w, n in counts.items():
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        edits = {a + b[1:] for a, b in cuts} | {a + c + b[k:] for a, b in cuts for c in letters for k in (0, 1)}
        found = edits & counts.keys() - {w}
        best = min(found, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [form, None, n, len(found), counts[form] if form is not None else None]
    for w, row in out.items():
        end = w
        while out[end][0] is not None:
            end = out[end][0]
        row[1] = end
    return {w: tuple(row) for w, row in out.items()}


def groups(frame):
    rows = frame.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def plain_counts(documents, least=7, least_n=2):
    counts = Counter()
    for key, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if key is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= least_n}


def test_spelling_query(spark, documents):
    expected = plain_groups(plain_counts(documents))
    found = groups(QUERIES["op11_spelling_variants"](spark, SMALL))
    assert found == expected and sum(r[0] is not None for r in found.values()) > 5


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 3 * 8192])
def test_spelling_in_rounds_and_small_cells(spark, filter_bytes):
    made = random.Random(21)
    counts = {}
    while len(counts) < 1500:
        word = "".join(made.choice("abcà×ÿ") for _ in range(made.randint(1, 9)))
        counts[word] = made.choice([1, 1, 2, 10, 20, 200, 4000, 10 ** 6])
    for base in ("ü" * 90, "long" * 40):
        counts |= {base: 5000, base + "z": 400, base[:50] + base[51:]: 3, "z" + base[1:]: 7}
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, form string")
    assert groups(spelling.spelling_groups(frame, 10, filter_bytes, 60)) == plain_groups(counts)


def test_spelling_chains_and_ties(spark):
    counts = {"abcdefg": 1, "abcdefgh": 10, "abcdefghi": 100, "abcdefghij": 1000, "abcdefgx": 10, "abcdefgi": 9, "zzzzzzz": 5}
    found = groups(spelling.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found == plain_groups(counts)
    assert found["abcdefg"][:2] == ("abcdefgh", "abcdefghij") and found["zzzzzzz"] == (None, "zzzzzzz", 5, 0, None)


def test_filters_let_every_word_pass():
    made = random.Random(3)
    words = sorted({"".join(made.choice("abcdeß") for _ in range(8)) for _ in range(3000)})
    layout = spelling.Layout({8: len(words)}, 500)
    hashes = spelling.word_hashes(words)
    cells = layout.cell(8, hashes)
    assert layout.total == 6 and set(cells) == set(range(6))
    filters = spelling.Filters(layout, 0, b"".join(spelling._filled(hashes[cells == c]) for c in range(6)))
    assert len(filters.possible(8, hashes)) == len(words)
    others = spelling.word_hashes(["x" + w for w in words])
    assert len(filters.possible(8, others)) < 10 and len(filters.possible(9, others)) == 0


def test_spelling_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "Example example EXAMPLE"), (3, "Example example EXAMPLE"), (None, "exampel examples " * 40),
             (4, "x" * 100_000 + " " + "x" * 100_001), (5, "É" * 8 + " é" * 8)]
    texts += [(6, "x" * 100_000 + " " + "x" * 100_001)]
    frame = spark.createDataFrame(odd_rows(texts), ODD).repartition(3)
    found = groups(spelling.spelling_variants(frame, slip, ratio=3))
    short = {w: r for w, r in found.items() if len(w) < 100}
    assert short == plain_groups({w: n for w, n in plain_counts(texts).items() if len(w) < 100}, 3)
    assert sorted((len(w), r[3]) for w, r in found.items() if len(w) > 100) == [(100_000, 1), (100_001, 1)]
    assert spelling.spelling_variants(spark.createDataFrame([], ODD)).collect() == []
    with pytest.raises(ValueError):
        spelling.spelling_groups(frame, 1)


# SentencePiece


def test_sentence_pieces_query(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = dict(documents)
    rows = QUERIES["op12_sentence_pieces"](spark, SMALL).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = model.encode(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(model.decode(ids)) and r["span_bytes"] == len(text.encode())


SAMPLES = ["ab ", "aeiou   th", "é日本 \n<0x>1", "abcdefghij", "   ", "▁ a😀", "the and of ing ", "ｆｕｌｌ　①  ﬁ é ¨ が",
           "<s> </s>", "¨ \ta", "\u0000\u0001a ​"]


def samples(seed, n, most):
    made = random.Random(seed)
    for _ in range(n):
        letters = made.choice(SAMPLES)
        yield "".join(made.choice(letters) for _ in range(made.randint(0, most)))


def same_as_library(coder, text):
    (ids, begins, ends), = coder.encode([text])
    expected = coder.model.encode(text, return_type="proto").pieces
    assert list(zip(ids, begins.tolist(), ends.tolist())) == [(p.id, p.begin, p.end) for p in expected], text


def changed_model(normaliser, suffix=0, without_bytes=False):
    """The model of the file with another normaliser, and perhaps without byte pieces."""
    with open(MODEL, "rb") as file:
        model, parts = file.read(), []
    for number, value, raw in pieces.message_fields(model):
        if number == pieces.TRAINER:
            own = b"".join(r for n, _, r in pieces.message_fields(value)
                           if n not in (pieces.MARK_AS_SUFFIX, *([pieces.BYTE_FALLBACK] if without_bytes else [])))
            raw = pieces.message_field(number, own + pieces.message_field(pieces.MARK_AS_SUFFIX, suffix))
        if number == pieces.PIECES and without_bytes:
            own = {n: v for n, v, _ in pieces.message_fields(value)}
            if own.get(pieces.KIND) == pieces.BYTE:
                continue
        if number != pieces.NORMALISER:
            parts.append(raw)
    return b"".join(parts) + pieces.message_field(pieces.NORMALISER, normaliser)


def test_spans_are_those_of_the_library():
    with open(MODEL, "rb") as file:
        coder = pieces.PieceCoder(file.read())
    for text in samples(1, 1500, 60):
        same_as_library(coder, text)


@pytest.fixture(scope="module")
def character_map():
    """A public character map of 225,000 rules (Unicode NFKC and more), compiled by the library."""
    made = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    spec = next(v for n, v, _ in pieces.message_fields(made) if n == pieces.NORMALISER)
    return next(v for n, v, _ in pieces.message_fields(spec) if n == pieces.CHARACTER_MAP)


def test_compiled_rules_are_read(character_map):
    rules = pieces.compiled_rules(character_map)
    assert len(rules) > 200_000 and rules["①"] == "1" and rules["ﬁ"] == "fi" and rules["\u304b\u3099"] == "\u304c"
    assert pieces.compiled_rules(b"") == {}


def test_normalised_texts_keep_their_places(character_map):
    for prefix, squeeze, suffix in ((1, 1, 0), (0, 0, 0), (1, 0, 0), (1, 1, 1)):
        spec = (pieces.message_field(pieces.CHARACTER_MAP, character_map) + pieces.message_field(pieces.DUMMY_PREFIX, prefix)
                + pieces.message_field(pieces.REMOVE_SPACES, squeeze))
        coder = pieces.PieceCoder(changed_model(spec, suffix))
        for text in samples(prefix + 2 * squeeze, 400, 30):
            same_as_library(coder, text)


def test_models_without_byte_pieces():
    coder = pieces.PieceCoder(changed_model(pieces.message_field(pieces.NAME, b"identity"), without_bytes=True))
    assert not coder.all_bytes
    for text in samples(5, 400, 30):
        same_as_library(coder, text)


def test_long_texts_in_parts():
    with open(MODEL, "rb") as file:
        coder = pieces.PieceCoder(file.read(), chunk=30)
    for text in samples(7, 400, 600):
        same_as_library(coder, text)


def test_sentence_pieces_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "same"), (4, "same"), (None, "no key"), (5, "lorem ipsum " * 100_000),
             (6, "x" * 200_000)]
    frame = spark.createDataFrame(odd_rows(texts), ODD).repartition(3)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = pieces.sentence_pieces(frame, MODEL, spans=True).collect()
    key = lambda r: tuple(map(str, r))
    expected = []
    for k, text in texts:
        ids = model.encode(text or "")
        expected.append((k, len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)), len((text or "").encode())))
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(expected, key=key)
    for r in found:
        assert len(r["ids"]) == len(r["begins"]) == len(r["ends"]) == r["n_tokens"] and r["begins"] == sorted(r["begins"])
    assert pieces.sentence_pieces(spark.createDataFrame([], ODD), MODEL).collect() == []


# Periodic runs


def plain_runs(words, least=24, times=3):
    out = []
    for q in range(1, len(words) // times + 1):
        i = q
        while i < len(words):
            end = i
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            start = i - q
            if end > i and end - start >= max(least, times * q) and not any(
                    q % p == 0 and words[start + p:end] == words[start:end - p] for p in range(1, q)):
                out.append((start, end - start, q))
            i = max(end, i) + 1
    return sorted(out)


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_periodic_runs_query(spark, documents):
    texts, seen = dict(documents), 0
    rows = QUERIES["op13_periodic_runs"](spark, SMALL).collect()
    assert len(rows) == len(documents)
    for r in rows:
        words = planted(r["doc_id"], words_of(texts[r["doc_id"]]))
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
        expected = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(kept)))
        assert tuple(r)[1:] == expected
        seen += bool(runs)
    assert seen > 10


def test_runs_of_all_kinds():
    made = random.Random(2)
    for _ in range(1500):
        least, times = made.choice([(24, 3), (6, 3), (4, 2), (12, 2), (9, 4)])
        words = []
        while len(words) < made.randint(1, 140):
            kind = made.randint(0, 2)
            if kind == 0:
                words += [made.randrange(made.choice([2, 3, 50])) for _ in range(made.randint(1, 30))]
            elif kind == 1 and words:
                at = made.randrange(len(words))
                words += words[at:at + made.randint(1, 40)]
            else:
                unit, n = [made.randrange(made.choice([2, 50])) for _ in range(made.randint(1, 12))], made.randint(1, 60)
                words += (unit * n)[:n]
        expected = plain_runs(words, least, times)
        assert runs_of(words, least, times) == expected
        assert periodic_runs_of([b"%d" % w for w in words], least, times) == expected


def test_overlapping_runs_and_ties():
    words = list(b"ab" * 12 + b"cd" * 12)
    runs = periodic_runs_of([bytes([w]) for w in words], 24, 3)
    assert runs == [(0, 24, 2), (24, 24, 2)] and strongest(runs) == (0, 24, 2)
    assert collapse([bytes([w]) for w in words], runs) == [b"a", b"b", b"c", b"d"]


def test_periodic_runs_odd_rows(spark):
    long = [f"w{i % 977}" for i in range(60_000)]
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "again and " * 30), (4, "again and " * 30), (None, "x " * 24), (5, "x " * 23),
             (6, " ".join(long)), (7, "y" * 200_000)]
    frame = spark.createDataFrame(odd_rows(texts), ODD).repartition(3)
    found = periodic_runs(frame, spans=True, collapsed=True).collect()
    told = {}
    for r in found:
        told.setdefault(r["doc_id"], []).append((list(zip(r["starts"], r["lengths"], r["periods"])), r["collapsed"]))
    assert told == {1: [([], "")], 2: [([], "")], 3: [([], "")], 4: [([(0, 60, 2)], "again and")] * 2, None: [([(0, 24, 1)], "x")],
                    5: [([], " ".join("x" * 23))], 6: [([(0, 60_000, 977)], " ".join(long[:977]))], 7: [([], "y" * 200_000)]}
    assert periodic_runs(spark.createDataFrame([], ODD)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(frame, 3, 2)


def test_repeats_are_planted_as_stated(spark, documents):
    from holdfast.llm.catalog import with_repeats

    frame = spark.createDataFrame([*documents, (None, "a b"), (20, None), (24, ""), (29, "one")], "doc_id long, text string")
    assert frame.where(F.col("text").isNull()).count() == 1
    for r in with_repeats(frame).collect():
        source = [words_of(t) for k, t in [*documents, (None, "a b"), (20, None), (24, ""), (29, "one")] if k == r["doc_id"]]
        assert words_of(r["text"]) in ([planted(r["doc_id"], w) for w in source] if r["doc_id"] is not None else source)


def test_letter_weights_differ():
    assert len(set(spelling._letter_weights(np.arange(97, 256)).tolist())) == 159
