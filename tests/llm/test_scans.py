"""Licence scan, quality rules, token counts and pieces against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import tuples

from llm.conftest import ODD
from ratestrata.llm import license_scan, packing, pieces, quality_rules, token_counts

LICENCE_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


def licence_row(text):
    words, places, labels = LICENCE_WORD.findall((text or "").translate(LOWER)), [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        own = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENSED = [
    (20, "Released under the MIT License. under the mit license"), (21, "Apache License, Version 2.0 and cc-by/nc 4"),
    (22, "under the mit under the mit license"), (23, "cc by nc cc by nc"), (24, "under the mit licenses"), (25, "éapache license version 2"),
    (26, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
         " (the 'Software'), to deal in the Software without restriction, including"),
    (27, "permission is hereby granted"),
]


def test_licences_equal_brute_force(documents):
    rows = ODD + LICENSED
    found = license_scan.licences(documents(*rows))
    got = tuples(found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert got == sorted(((i, *licence_row(t)) for i, t in rows), key=str)


def test_longer_texts_need_their_key_phrase_and_most_words(documents):
    found = {r.doc_id: r for r in license_scan.licences(documents(*LICENSED)).collect()}
    assert found[26].labels == "mit" and found[26].base_labels == "" and 0.7 <= found[26].score <= 1
    assert found[27].labels == "" and found[27].score == 0
    assert [(m.label, m.word, m.length) for m in found[23].matches] == [("cc-by-nc", 0, 3), ("cc-by-nc", 3, 3)]


def test_licences_of_an_empty_table(no_documents):
    assert license_scan.licences(no_documents).count() == 0


def rules_row(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(inside),
    )


RULED = [(30, "a b c a b c"), (31, "x\nx\ny | z\n\nx"), (32, "a a a a"), (33, " ".join(f"w{i}" for i in range(60))), (34, "a b c d a b c\n" * 9)]


def test_measurements_equal_brute_force(documents):
    rows = ODD + RULED
    found = quality_rules.ledger(documents(*rows)).select("doc_id", *quality_rules.MEASURES[:6])
    assert tuples(found) == sorted(((i, *rules_row(t)) for i, t in rows), key=str)


def test_policies_and_ablations_read_the_ledger_only(documents):
    entries = quality_rules.ledger(documents(*ODD, *RULED)).cache()
    kept = entries.where(quality_rules.WEB.keeps())
    assert tuples(kept.select("doc_id")) == [(33,)]
    assert tuples(quality_rules.passing(documents(*ODD, *RULED)).select("doc_id")) == [(33,)]
    for rule, failed, n_kept, without in tuples(quality_rules.ablations(entries, quality_rules.WEB)):
        rest = quality_rules.Policy("rest", 1, tuple(r for r in quality_rules.WEB.rules if r != rule))
        assert failed == entries.where(~quality_rules.Policy("one", 1, (rule,)).keeps()).count()
        assert (n_kept, without) == (1, entries.where(rest.keeps()).count())


def test_rules_keep_the_columns_and_work_on_an_empty_table(documents, no_documents):
    docs = documents(*RULED)
    assert quality_rules.passing(docs).schema == docs.schema
    assert quality_rules.ledger(no_documents).count() == 0


@pytest.mark.parametrize("width", [1, 3, 7, 1 << 20])
def test_token_counts_equal_the_ids_written(documents, spark, width):
    """With the separator of the query, which texts may spell, and with very long texts."""
    from tokenizers import Tokenizer

    from ratestrata.llm.common import Workspace

    tokenizer = packing.default_tokenizer()
    rows = [(i, t) for i, t in ODD if width > 100 or not t or len(t) < 1000] + [(40 + i, "some text " * i) for i in range(12)]
    rows += [(60, "a<|endoftext|>b <|endoftext|>"), (61, "<|endoftext|>"), (62, "x"), (None, "no id"), (62, "x")]
    library = Tokenizer.from_file(tokenizer)
    library.encode_special_tokens = True
    end, work = token_counts.end_of_text(tokenizer), Workspace(spark, "files")
    register = work.store(token_counts.write_files(documents(*rows).repartition(3), tokenizer, end, f"{work.root}/files"), "register")
    found = token_counts.token_counts(register.where("ordinal is null").select("file", "size"), end, "<u2", width)
    got = register.where("ordinal is not null").drop("size").join(found, ["file", "ordinal"])
    wanted = sorted(((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    assert tuples(got.select("doc_id", "n_tokens")) == wanted
    assert found.count() == len(rows)


def test_the_query_counts_like_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    library.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted(((i, len(e.ids)) for (i, _), e in zip(docs, library.encode_batch([t or "" for _, t in docs], add_special_tokens=False))), key=str)
    assert tuples(token_counts.op8_token_counts(spark, "/root/testdata/sf0.001").select("doc_id", "n_tokens")) == wanted


def broadcast_columns(df):
    """Names of the columns that the broadcasts of a plan that ran have sent through the driver, one set for each."""
    df.collect()
    found, rest = [], [df._jdf.queryExecution().executedPlan()]
    while rest:
        node = rest.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            rest.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            rest.append(node.plan())
        else:
            if kind == "BroadcastExchangeExec":
                found.append({node.output().apply(i).name() for i in range(node.output().size())})
            rest += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_no_table_that_grows_with_the_documents_is_broadcast(documents, spark, tmp_path):
    """Files of a few MB can hold millions of rows, each with the path of its token file."""
    documents(*((i, "a b " * (i % 3)) for i in range(2000)), (None, None), (7, "x")).write.parquet(f"{tmp_path}/documents.parquet")
    counted = token_counts.op8_token_counts(spark, str(tmp_path))
    assert not [names for names in broadcast_columns(counted) if names & {"doc_id", "ends", "stop", "n_tokens"}]
    assert counted.count() == 2002
    small = documents((1, "a")).select("doc_id")  # the walk finds a broadcast where there is one
    assert broadcast_columns(small.join(small.select("doc_id").hint("broadcast"), "doc_id")) == [{"doc_id"}]


def test_a_text_with_the_separator_is_refused(documents, tmp_path):
    tokenizer = packing.default_tokenizer()
    (one,) = token_counts.plain_units(tokenizer).encode([["x"]])
    with pytest.raises(Exception, match="of the end"):
        token_counts.write_files(documents((1, "x")), tokenizer, int(one[0]), str(tmp_path)).collect()


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_token_counts_of_raw_files_with_an_open_end(spark, tmp_path, kind):
    import numpy as np

    for name, ids in (("a", [5, 6, 0, 0, 7, 0]), ("b", [1, 2, 3]), ("c", []), ("d", [0] + [9] * 50 + [0, 4])):
        (tmp_path / f"{name}.bin").write_bytes(np.array(ids, kind).tobytes())
    files = token_counts.files_below(spark, str(tmp_path), kind)
    for width in (1, 4, 1000):
        found = token_counts.token_counts(files, 0, kind, width)
        assert sorted(r.n_tokens for r in found.collect()) == sorted([2, 0, 1, 3, 0, 50, 1])
    assert tuples(found.where("file like '%d.bin'").select("ordinal", "start", "n_tokens")) == [(0, 0, 0), (1, 1, 50), (2, 52, 1)]
    assert token_counts.token_counts(files.where("false"), 0, kind).count() == 0


def test_a_file_above_two_gigabytes_is_read_by_ranges(spark, tmp_path):
    import os

    import numpy as np

    path, size = tmp_path / "large.bin", (1 << 30) + 5000
    with open(path, "wb") as file:  # a sparse file: zeros take no disk
        for place in (7, 1 << 29, size - 2):
            file.seek(place * 2)
            file.write(np.array([9], "<u2").tobytes())
        file.truncate(size * 2)
    assert os.path.getsize(path) > 1 << 31
    found = token_counts.token_counts(token_counts.files_below(spark, str(path), "<u2"), 9, "<u2", 1 << 24)
    assert tuples(found.select("ordinal", "start", "n_tokens")) == [
        (0, 0, 7), (1, 8, (1 << 29) - 8), (2, (1 << 29) + 1, size - 3 - (1 << 29)), (3, size - 1, 1),
    ]


def test_pieces_equal_the_library(documents, spark):
    from sentencepiece import SentencePieceProcessor

    model = public_tokenizers.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=model)
    rows = ODD + [(50, " lead"), (51, "trail "), (52, "a" * 200 + " " * 40 + "b"), (53, "́ ￾� ꙮ"), (54, "don't—stop…")]
    docs = documents(*rows)
    assert pieces.differing(docs, model).count() == 0
    assert pieces.differing(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), model).count() == 0

    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    wanted = []
    for i, text in rows:
        ids = library.encode(text or "", add_eos=True)
        wanted.append((i, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    assert tuples(pieces.round_trip(docs, model)) == sorted(wanted, key=str)
    back = pieces.decoded(pieces.encoded(docs, model), model)
    assert tuples(back) == sorted(((i, library.decode(library.encode(t or ""))) for i, t in rows), key=str)


def test_the_query_compares_each_row_with_the_library(documents, spark, tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    found = pieces.op7_pieces(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and found.where("agrees is null or not agrees").count() == 0

    model = public_tokenizers.path("piece_bpe_32k.model")
    proto = sentencepiece_model_pb2.ModelProto()
    with open(model, "rb") as file:
        proto.ParseFromString(file.read())
    for piece in proto.pieces:
        if piece.type == proto.SentencePiece.Type.NORMAL:
            piece.score = -20000 - piece.score  # the worst merges first
    (tmp_path / "other.model").write_bytes(proto.SerializeToString())
    docs = documents((1, ""), (2, "an international understanding"))
    assert tuples(pieces.round_trip(docs, model, library=model).select("doc_id", "agrees")) == [(1, True), (2, True)]
    assert tuples(pieces.round_trip(docs, model, library=str(tmp_path / "other.model")).select("doc_id", "agrees")) == [(1, True), (2, False)]


def test_broken_bytes_decode_like_the_library():
    from sentencepiece import SentencePieceProcessor

    model = public_tokenizers.path("piece_bpe_32k.model")
    library, own = SentencePieceProcessor(model_file=model), pieces.piece_model(model)
    for ids in ([3 + 0xE9, 3 + 0x41], [3 + 0xE2, 3 + 0x82], [3 + 0xFF, 500, 3 + 0xC3, 3 + 0xA9, 2], [0, 500], [1, 261, 2]):
        assert own.decode(ids).decode() == library.decode(ids)


def test_the_two_agendas_agree():
    """In step and by a heap, on strings around the length at which the form changes, and against the library."""
    import random

    from sentencepiece import SentencePieceProcessor

    model = public_tokenizers.path("piece_bpe_32k.model")
    own, library = pieces.piece_model(model), SentencePieceProcessor(model_file=model)
    rng = random.Random(7)
    texts = ["international", "\u2581" * 7, "aaaaaaaaaaaa", "thethethe", "x", "\U0001f600", "ꙮꙮ", "a" * 47, "a" * 48, "a" * 500]
    for n in [*range(1, 12), 40, 46, 47, 48, 49, 50, 90]:
        for letters in ("ab", "etaoinshr", "theing", "éàü漢字ꙮz"):
            texts += ["".join(rng.choices(letters, k=n)) for _ in range(6)]
    for text in texts:
        symbols = own.symbols[np.array([[ord(c) for c in text]])]
        found, n = own._agendas(symbols)
        assert found[0, : n[0]].tolist() == own.agenda(text), text
    assert [x.tolist() for x in own.encode(texts)] == library.encode(texts, add_eos=True)
