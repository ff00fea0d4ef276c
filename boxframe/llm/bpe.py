"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Every pre-token's pair ranks are the leaves of a segment tree of minima; its
root is the leftmost pair of lowest rank. A merge changes three leaves, each
by a point update of logarithmic cost, until no pair can merge. So a word of n
symbols costs O(n log n), whatever its length. Encoded pre-tokens are kept in
a bounded cache per Python worker (a cache only: it never changes a result).

The tokenizer file is a public one, its path a parameter; it is read on the
driver and broadcast (its size is that of the file). Supported: BPE models with
an end-of-word suffix, lower-casing NFC normalisation, and the usual split into
letters, single numbers and others (see ``DECLARED``); a file that declares
anything else is refused, since its ids would be wrong.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from boxframe.llm.common import map_arrow, slices, worker_state

CACHE = 400_000
#: What a tokenizer file must declare, as its format names it, to be encoded and decoded as built here.
DECLARED = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True,
         "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}]},
    "decoder": None,
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False},
    "added_tokens": {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False},
}
COLUMNS = {
    "n_tokens": "bigint", "ids": "array<int>", "tokens": "array<string>", "decoded": "string",
    "ids_sha256": "string", "decoded_sha256": "string",
}


@cache
def patterns() -> tuple[re.Pattern, re.Pattern]:
    """Pre-tokens, and what keeps a text from being plain.

    Pre-tokens are split as the tokenizer files name them: contractions, letters, single numbers,
    others; white space is dropped. A plain text is letters, white space and lone full stops and commas.
    The classes come from the standard library's Unicode tables, by which the
    letters of later Unicode versions are not letters yet.
    """

    def kind(c: int) -> str:
        letter = chr(c)
        if letter.isspace() and not 0x1C <= c <= 0x1F:  # the separators are no white space by Unicode's property
            return "Z"
        return unicodedata.category(letter)[0]

    ranges: dict[str, list[str]] = {"L": [], "N": [], "Z": []}
    for k, run in groupby(range(sys.maxunicode + 1), kind):
        if k in ranges:
            codes = list(run)
            ranges[k].append(f"\\U{codes[0]:08x}-\\U{codes[-1]:08x}")
    letters, numbers, white = ("".join(ranges[k]) for k in "LNZ")
    # The alternatives begin with different letters but for the last, so the most frequent may come first.
    return (re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{white}{letters}{numbers}]+"),
            re.compile(f"[^{letters}{white}.,]|[.,][.,]"))


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a normalised text. Plain texts and lines are split without the pattern, to the same result."""
    token, odd = patterns()
    if not odd.search(text):
        return text.replace(".", " . ").replace(",", " , ").split()
    out: list[str] = []
    for line in text.split("\n"):
        out += token.findall(line) if odd.search(line) else line.replace(".", " . ").replace(",", " , ").split()
    return out


@dataclass(frozen=True)
class Vocabulary:
    """What the workers need of a tokenizer file."""

    ids: dict[str, int]
    merges: list[tuple[str, str]]
    suffix: str
    special: dict[str, int]


def _differs(found: object, want: object) -> bool:
    """Whether a declaration lacks or contradicts what is wanted of it; keys that nothing is wanted of don't matter."""
    if isinstance(want, dict):
        return not isinstance(found, dict) or any(_differs(found.get(k), x) for k, x in want.items())
    if isinstance(want, list):
        return not isinstance(found, list) or len(found) != len(want) or any(map(_differs, found, want))
    return (found or None) != (want or None)  # an option that is left out is off


def load(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file; ``ValueError`` if it declares another tokenizer than the one built here."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    for part, want in DECLARED.items():
        found = raw.get(part)
        if any(_differs(x, want) for x in (found or ())) if part == "added_tokens" else _differs(found, want):
            raise ValueError(f"{path}: its {part} is not supported: {str(found)[:500] if part != 'model' else {k: found.get(k) for k in want}}")
    model = raw["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in raw["added_tokens"]}
    return Vocabulary(model["vocab"], merges, model.get("end_of_word_suffix") or "", special)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [], 256
    for b in range(256):
        if b in own:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary, cache: int = CACHE) -> None:
        v = vocabulary
        letters = byte_letters()
        self.inner = [v.ids.get(c, -1) for c in letters]
        self.last = [v.ids.get(c + v.suffix, -1) for c in letters]
        self.shift = max(v.ids.values(), default=0).bit_length()
        self.rank = {v.ids[a] << self.shift | v.ids[b]: r for r, (a, b) in enumerate(v.merges)}
        self.merged = [v.ids[a + b] for a, b in v.merges]
        self.token = {i: t for t, i in (v.ids | v.special).items()}
        self.special = v.special
        self.split = re.compile("(" + "|".join(re.escape(s) for s in sorted(v.special, key=len, reverse=True)) + ")") if v.special else None
        self.heads = sorted({s[0] for s in v.special})
        self.name = {i: str(i) for i in self.token}
        self.by_name = {self.name[i]: t for i, t in self.token.items()}
        self.complete = min(self.inner) >= 0 and min(self.last) >= 0
        # Two generations, so that frequent words outlive a full cache.
        self.cache: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.limit = cache // 2

    def merge(self, ids: list[int]) -> list[int]:
        """Merge pairs, lowest rank first and leftmost among equals, until none is left."""
        n = len(ids)
        if n < 2:
            return ids
        ids, rank, shift = ids[:], self.rank, self.shift
        size = 1
        while size < n - 1:
            size *= 2
        none = len(self.merged) * n
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = rank.get(ids[i] << shift | ids[i + 1])
            if r is not None:
                tree[size + i] = r * n + i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before, merged, get = list(range(1, n + 1)), list(range(-1, n - 1)), self.merged, rank.get
        low = tree[1]
        while low < none:
            r, at = divmod(low, n)
            gone = after[at]
            right = after[at] = after[gone]
            new = ids[at] = merged[r]
            ids[gone] = -1
            value = none
            if right < n:
                before[right] = at
                r = get(new << shift | ids[right])
                if r is not None:
                    value = r * n + at
            i = size + at
            tree[i] = value
            j = size + gone
            if j < 2 * size:  # the last symbol starts no pair
                tree[j] = none
                if j != i ^ 1:
                    while j > 1:
                        j >>= 1
                        a, b = tree[2 * j], tree[2 * j + 1]
                        low = a if a < b else b
                        if tree[j] == low:
                            break
                        tree[j] = low
            left = before[at]
            if left >= 0:
                r = get(ids[left] << shift | new)
                j = size + left
                tree[j] = none if r is None else r * n + left
                if j != i ^ 1:
                    while j > 1:
                        j >>= 1
                        a, b = tree[2 * j], tree[2 * j + 1]
                        low = a if a < b else b
                        if tree[j] == low:
                            break
                        tree[j] = low
            while i > 1:
                i >>= 1
                a, b = tree[2 * i], tree[2 * i + 1]
                low = a if a < b else b
                if tree[i] == low:
                    break
                tree[i] = low
            low = tree[1]
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> str:
        """Ids of one pre-token, as text."""
        out = self.old.get(word)
        if out is None:
            out = self.encode_word(word)
        if len(word) < 64:
            if len(self.cache) >= self.limit:
                self.cache, self.old = {}, self.cache
            self.cache[word] = out
        return out

    def encode_word(self, word: str) -> str:
        raw = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        ids = self.merge([i for i in ids if i >= 0])
        return " ".join([self.name[i] for i in ids])

    def names(self, text: str) -> str:
        """Ids of a whole text, as text; pre-tokens without any known letter have none."""
        out: list[str] = []
        for part in self.split.split(text) if self.split and any(h in text for h in self.heads) else (text,):
            if part in self.special:
                out.append(str(self.special[part]))
                continue
            if not unicodedata.is_normalized("NFC", part):
                part = unicodedata.normalize("NFC", part)
            # Letter by letter: str.lower alone would write a final sigma by its context.
            get, word = self.cache.get, self.word
            out += [get(w) or word(w) for w in pre_tokens(part.replace("Σ", "σ").lower())]
        return " ".join(out if self.complete else [x for x in out if x])

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.names(text).split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space (files without a decoder); special tokens stay."""
        return self.decode_names(" ".join([str(i) for i in ids if i in self.token]))

    def decode_names(self, names: str) -> str:
        """``decode`` of ids given as text."""
        return " ".join(map(self.by_name.__getitem__, names.split(" "))) if names else ""




def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     columns: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Encode and decode every whole text: the id and the asked ``columns`` (see ``COLUMNS``), one row per input row.

    A NULL text counts as empty (no ids, decoded to the empty text). Texts that
    hold the string of a special token get its id. The decoded text is made
    from the ids' tokens. Repeated rows give repeated results.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(path))
    mark, decodes = uuid4().hex, any("decoded" in c or c == "tokens" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_state(mark, lambda: Bpe(shared.value))
        for batch in slices(batches, "__text"):
            out: dict[str, list] = {c: [] for c in columns}
            for text in batch.column(1).to_pylist():
                names = bpe.names(text) if text else ""
                decoded = bpe.decode_names(names) if decodes else ""
                for c in columns:
                    if c == "n_tokens":
                        out[c].append(names.count(" ") + bool(names))
                    elif c == "ids":
                        out[c].append(np.fromstring(names, np.int32, sep=" "))
                    elif c == "tokens":
                        out[c].append(decoded.split(" ") if decoded else [])
                    elif c == "decoded":
                        out[c].append(decoded)
                    elif c == "ids_sha256":
                        out[c].append(hashlib.sha256(names.encode()).hexdigest())
                    else:
                        out[c].append(hashlib.sha256(decoded.encode()).hexdigest())
            kinds = {"bigint": pa.int64(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()), "string": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(out[c], kinds[COLUMNS[c]]) for c in columns]], [id_col, *columns])

    kind = dict(docs.dtypes)[id_col]
    schema = ", ".join([f"`{id_col}` {kind}", *[f"{c} {COLUMNS[c]}" for c in columns]])
    chosen = docs.select(docs[id_col], docs[text_col].alias("__text"))
    return map_arrow(chosen, run, schema)
