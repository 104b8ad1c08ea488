"""Quality rules, licenses, token counts and token files against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from logquarry.llm import queries
from logquarry.llm.licenses import BASE, LOWER, UPPER, licenses
from logquarry.llm.quality_rules import Condition, learn, quality, statistics
from logquarry.llm.token_counts import count_tokens
from logquarry.llm.token_files import decode_ranks, encode_ranks, read_token_files, write_token_files
from tokenizers import Tokenizer

from .conftest import SF

ODD = ["", None, " ", "a", " a b c a b c ", "a b a b a b a", "x\n\n \nx\ny\nx", "\x0ba\x1cb c d", "a a a a", "#a$ <b>|\n#a$ <b>|"]
LONG = "word " * 20_000 + "x" * 70_000


def plain_statistics(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen = Counter(zip(words, words[1:], words[2:]))
    places = {k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(places)


def test_statistics(documents, texts, frame):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for row in statistics(documents).collect():
        assert tuple(row[n] for n in names) == plain_statistics(texts[row.doc_id])
    odd = [*ODD, LONG]
    for row in statistics(frame([(i, x) for i, x in enumerate(odd)] * 2)).collect():
        assert tuple(row[n] for n in names) == plain_statistics(odd[row.doc_id])


def test_rules_are_learned_and_used(spark, documents, texts):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = {r.doc_id: r for r in queries.QUERIES["op1_quality_rules"](spark, SF).collect()}
    assert set(found) == set(texts)
    for row in found.values():
        n = plain_statistics(texts[row.doc_id])
        assert row.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (row.base_failed and row.kept)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert all(found[i].kept or found[i].base_failed for i in good)
    assert sum(not found[i].kept for i in bad) >= 0.9 * len(bad)
    assert quality(documents, labels.limit(0)).where("kept = base_failed").count() == 0
    assert quality(documents.limit(0), labels).count() == 0


def test_learner_finds_the_threshold():
    base = dict.fromkeys(["word_length", "duplicate_line_share", "repeat_share", "capital_share", "digit_share"], 0.5)
    rows = [base | {"symbol_share": i / 300, "bad": i > 200, "prune": i % 3 == 0} for i in range(300)]
    (rule,) = learn(rows)
    assert rule[0].feature == "symbol_share" and rule[0].above and 195 < 300 * rule[0].threshold < 206
    assert learn([r | {"bad": False} for r in rows]) == [] and learn([]) == []
    assert isinstance(rule[0], Condition)


def plain_licenses(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    starts, labels = [], set()
    for phrase, label in BASE.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licenses(documents, texts, frame):
    rows = licenses(documents).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        assert tuple(row)[1:6] == plain_licenses(texts[row.doc_id])
        assert set(row.base_labels.split(",")) <= set(row.labels.split(",")) | {""}
    odd = [
        *ODD,
        "CC BY cc by",
        "cc-by-cc by",
        "All rights reserved. all  RIGHTS reserved",
        "İ K cc BY",
        "cc by general public license",
        "all rights " * 500 + "reserved",
    ]
    rows = licenses(frame([(i, x) for i, x in enumerate(odd)] * 2, ", row int, label int")).collect()
    assert len(rows) == 2 * len(odd)
    for row in rows:
        assert tuple(row)[1:6] == plain_licenses(odd[row.doc_id])
    assert licenses(documents.limit(0)).count() == 0


def test_templates_with_changed_words(frame):
    changed = (
        "Permission is hereby granted, free of charge, to anyone getting a copy of this software and associated"
        " documentation files. Released under the MIT license, so there. Not a license: the software is free."
    )
    mit, clean = licenses(frame([(0, changed), (1, "this work is free and the license is mine")])).orderBy("doc_id").collect()
    assert mit.labels == "mit" and 0.6 <= mit.score <= 1 and [x.start for x in mit.found] == [0, 19]
    assert clean.labels == "" and clean.score == 0


def test_token_counts(spark, texts, frame):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = queries.QUERIES["op10_token_counts"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    odd = [*ODD, LONG, "a  b", "\n\nx y", "a\n", "x \ny", "\ta b\rc", "▁a b", "ﬁ Å 漢字\n漢 字", "<s> </s>", "a\x00b", "\n"]
    rows += count_tokens(frame([(i + 1000, x) for i, x in enumerate(odd)], ", n_tokens int, n int"), limit=10).collect()
    for row in rows:
        text = (texts[row.doc_id] if row.doc_id < 1000 else odd[row.doc_id - 1000]) or ""
        n = len(model.encode(text))
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), n)
        assert row.over_limit == (n > (4096 if row.doc_id < 1000 else 10))
    assert count_tokens(frame([])).count() == 0


@pytest.mark.parametrize("top", [1, 1 << 8, 1 << 16, 1 << 24, (1 << 32) - 1])
def test_codes_round_trip(top):
    random = np.random.default_rng(top)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = random.integers(0, top + 1, n, np.uint32) >> random.integers(0, 25, n, np.uint32)
        assert (decode_ranks(*encode_ranks(ranks), n) == ranks).all()


def test_token_files(spark, texts, frame):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for row in queries.QUERIES["op6_token_files"](spark, SF).orderBy("doc_id").collect():
        ids = [*model.encode(texts[row.doc_id], add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    odd = [*ODD, LONG, "it's  WE’RE <|endoftext|>x́ ÀÉ İK ΑΣ ΣΑ", " a b", "\x85 \x1c"]
    files = write_token_files(frame([(i, x) for i, x in enumerate(odd)] * 2), block_tokens=64)
    rows = read_token_files(spark, files).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted([*range(len(odd))] * 2)
    for row in rows:
        assert row.ids == [*model.encode(odd[row.doc_id] or "", add_special_tokens=False).ids, 2]
    assert read_token_files(spark, write_token_files(frame([]))).count() == 0
