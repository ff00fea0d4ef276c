"""BPE against the tokenizers library, and the segment tree against a plain loop."""

import hashlib
import json
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from boxframe.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", "   \n", "Hello, World! don't we'll 123 4½ ²", "<|startoftext|>a<|endoftext|> <|endoftext|>b<|other|>",
    "ΣΊΣΥΦΟΣ ΟΔΟΣ. İstanbul ẞ ǅ", "é ñ ẛ̣ Å ﬁ 한글 한", "x\x00\x1c\x85  ​﻿y",
    "😀👍🏽 ... !!!'s 'S 'll'd", "a" * 5000, "ab" * 3000 + "!" * 777, "日本語テキスト русский текст עברית", "\t\x0b\x0c<|endoftext|>", "_-_ a_b 1_2",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.load(PATH))


def test_same_as_library(library, own):
    for text in TEXTS:
        want = library.encode(text or "", add_special_tokens=False).ids
        got = own.encode(text or "")
        assert got == want, text
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_same_as_library_on_random_text(library, own):
    rng = random.Random(5)
    alphabet = "aàbcdEÉ éêñß' \n\t.,!?0123456789<|>endoftext-_#*&ΣσİŁ中한ا́‍😀"
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_same_as_library_on_every_letter(library, own):
    odd = []
    for start in range(0x20, 0x20000, 64):
        text = " ".join(chr(c) for c in range(start, start + 64) if unicodedata.category(chr(c)) not in ("Cs", "Cn"))
        if own.encode(text) != library.encode(text, add_special_tokens=False).ids:
            odd.append(hex(start))
    assert odd == []


def test_merge_against_plain_loop(own):
    rng = random.Random(3)
    for _ in range(400):
        ids = [own.inner[ord(rng.choice("thean"))] for _ in range(rng.randint(1, 40))]
        plain = ids[:]
        while True:
            ranks = [(own.rank.get(a << own.shift | b, 10**9), i) for i, (a, b) in enumerate(zip(plain, plain[1:], strict=False))]
            if not ranks or min(ranks)[0] == 10**9:
                break
            r, i = min(ranks)
            plain[i : i + 2] = [own.merged[r]]
        assert own.merge(ids) == plain


def test_documents(spark, library):
    docs = spark.createDataFrame([(i, t, "x", 9) for i, t in enumerate(TEXTS)] + [(None, "Two", None, 1)] * 2, "doc_id bigint, text string, ids string, n_tokens int")
    out = bpe.encode_documents(docs, PATH, columns=tuple(bpe.COLUMNS)).collect()
    assert len(out) == len(TEXTS) + 2
    for r in out:
        text = ("Two" if r.doc_id is None else TEXTS[r.doc_id]) or ""
        want = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(want, skip_special_tokens=False)
        assert r.ids == want and r.decoded == decoded and r.n_tokens == len(want) and " ".join(r.tokens) == decoded
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = queries.op5_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(texts)
    for r in out:
        want = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_plain_texts_split_like_the_pattern():
    rng = random.Random(12)
    token, _ = bpe.patterns()
    for _ in range(3000):
        text = "".join(rng.choice("abéß .,\n\t\x1c\x85\xa0 '1!") if rng.random() < 0.3 else rng.choice("abc d.e, ") for _ in range(rng.randint(0, 30)))
        assert bpe.pre_tokens(text) == token.findall(text), repr(text)


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError, match="normalizer"):
        bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    with open(PATH, encoding="utf-8") as f:
        raw = json.load(f)
    raw["model"] |= {"vocab": {"a</w>": 0}, "merges": []}
    changes = {"normalizer": {"type": "NFC"}, "pre_tokenizer": None, "decoder": {"type": "ByteLevel"},
               "model": raw["model"] | {"byte_fallback": True}, "added_tokens": [raw["added_tokens"][0] | {"lstrip": True}]}
    for part, other in changes.items():
        path = tmp_path / f"{part}.json"
        path.write_text(json.dumps(raw | {part: other}))
        with pytest.raises(ValueError, match=part):
            bpe.load(str(path))
    path.write_text(json.dumps(raw))
    assert bpe.load(str(path)).ids == {"a</w>": 0}


def test_special_tokens_of_any_beginning():
    own = bpe.Bpe(bpe.Vocabulary({"a</w>": 0, "b</w>": 1}, [], "</w>", {"[end]": 2, "<s>": 3}))
    assert own.encode("a[end]b<s>a") == [0, 2, 1, 3, 0]
