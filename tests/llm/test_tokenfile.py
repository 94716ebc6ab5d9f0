import os
import random
import zlib

import numpy as np
import pytest

from sensorlake.llm import tokenfile as tf
from sensorlake.llm.common import Scratch, filesystem
from tests.llm.nasty import document_frame, documents, empty


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(tf.TOKENIZER))


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [tf.END], "<u4")


def test_round_trip_of_all_documents(spark, tokenizer):
    rows = documents()
    found = sorted(tf.token_documents(document_frame(spark)).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in found]
    assert keys == sorted((r[0] for r in rows), key=lambda x: (x is None, x or 0))
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    want = sorted((str(i), len(x), zlib.crc32(x.tobytes())) for i, x in ((i, ids_of(tokenizer, t)) for i, t, *_ in rows))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found) == want


def test_words_are_encoded_as_in_their_text(tokenizer):
    import public_tokenizers
    texts = [t or "" for _, t, *_ in documents()] + ["a\x1cb   c d\r\ne", "é ́x ᄀ ᅡ", "ΑΣ ΟΔΟΣ Σ", "'s 't it's<|startoftext|> <|endoftext|>", "🙂🙂 🙂 ퟿", "a  b   c", " ", "\n\n"]
    texts += ["don't can'T I'LL !'s ''s '' '' 'tis x'y'z 12a3 ×a÷b Ÿ Ǆ ǅ ĳ ſ İI ŉ a'b'c ~!@#$%^&*()_+ `-=[]\\;',./ <|x|>", "Été ÉTÉ naïve ÑANDÚ straße STRASSE Ø ÿ"]
    rng = random.Random(0)
    marks = [chr(c) for c in [*range(0x20, 0x250), 0x300, 0x301, 0x3A3, 0x3C2, 0x2019, 0xFB01, 0x1E9E, 0x2028, 0x3000]]
    texts += ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    got = tf.WordEncoder(public_tokenizers.path(tf.TOKENIZER))(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids_of(tokenizer, t).tolist()[:-1] for t in texts]


def test_files_roll_and_can_be_read_from_any_place(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK", 512)
    folder = Scratch(spark, "test").path("files")
    w = tf.Writer(folder, "one.idp")
    rng, texts = np.random.default_rng(0), []
    for i in range(50):
        ids = rng.integers(0, [200, 60_000, 1 << 31][i % 3], rng.integers(0, 400)).astype("<u4")
        texts.append(ids)
        w.add(i if i % 7 else None, ids.tobytes())
    row, r = w.close(), tf.Reader(folder, "one.idp")
    whole = np.concatenate(texts)
    assert (np.concatenate(list(r.blocks())) == whole).all() and row["tokens"] == len(whole)
    for a, n in ((0, 10), (511, 2), (1000, 1200), (len(whole) - 3, 3), (5, 0)):
        assert (r.ids(a, n) == whole[a:a + n]).all()
    doc, n, known = r.documents()
    assert n.tolist() == [len(x) for x in texts] and [d if k else None for d, k in zip(doc.tolist(), known)] == [i if i % 7 else None for i in range(50)]
    assert {len(b[2]) for b in r.index["blocks"]} <= {1, 2, 3, 4}


def test_reruns_write_the_same_files(spark):
    docs = document_frame(spark)
    folders = [Scratch(spark, "test").path("files") for _ in range(2)]
    read = []
    for f in folders:
        manifest = tf.write_token_files(docs, f, roll_bytes=2000)
        names = [r["file"] for r in manifest.orderBy("part", "seq").collect()]
        assert len(names) > 3
        root = filesystem(f)[1]
        assert not [x for x in os.listdir(root) if x.startswith("_tmp")]
        read.append(sorted(map(str, tf.read_documents(spark, f).collect())))
    assert read[0] == read[1]


def test_empty_table(spark):
    assert tf.token_documents(empty(document_frame(spark))).count() == 0


def test_torn_files_are_refused(spark):
    folder = Scratch(spark, "test").path("files")
    w = tf.Writer(folder, "one.idp")
    w.add(1, np.arange(5, dtype="<u4").tobytes())
    w.close()
    path = filesystem(folder)[1] + "/one.idp"
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-3])
    with pytest.raises(ValueError):
        tf.Reader(folder, "one.idp")
