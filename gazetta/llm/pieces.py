"""What the two tokenising operators share: tokenizers, and single pre-tokens.

Both tokenizers encode each pre-token alone, and no pre-token reaches across the start of a run
of white space. So a text may be cut there and its pieces encoded one by one, each distinct piece
once; the token ids are those of the whole text.
"""

from __future__ import annotations

import codecs
import contextlib
import gc
import json
import re
import string
from array import array
from collections.abc import Callable, Iterator

from tokenizers import Tokenizer

#: Pieces that a task keeps at most; beyond that it forgets all and starts again.
MEMORY = 250_000
#: A word of which the tokenizers make one pre-token for certain, a mark, and the same after a line's end.
#: Only letters whose lower case is one letter, too.
LETTERS = r"[A-Za-zÀ-ÖØ-öø-įı-ſ]+"
SIMPLE = re.compile(rf"({LETTERS})([.,])?(?:(\n)({LETTERS})([.,])?)?")
_LOADED: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    """The tokenizer at path, once for each worker, without truncation and padding."""
    if path not in _LOADED:
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = t
    return _LOADED[path]


def _simple_tokens(build: dict) -> bool:
    """Whether special strings hold no white space and take none from beside them."""
    return not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in build["added_tokens"])


def is_byte_level(tokenizer: Tokenizer) -> bool:
    """Whether texts may be cut before white space and behind words: no normaliser, byte-level pre-tokens of the usual pattern, plain BPE, a sign in each special string."""
    build = json.loads(tokenizer.to_str())
    pre, model = build["pre_tokenizer"] or {}, build["model"]
    usual = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    signs = all(set(string.punctuation).intersection(t["content"]) for t in build["added_tokens"])
    return bool(usual and build["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout") and _simple_tokens(build) and signs)


# The normaliser and pre-tokeniser of the tokenizers whose pre-tokens hold no white space.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}


def is_word_level(tokenizer: Tokenizer) -> bool:
    """Whether texts may be cut at white space: pre-tokens without it, each encoded alone, and tokens decoded as they are with spaces between."""
    build = json.loads(tokenizer.to_str())
    pre, model = build["pre_tokenizer"] or {}, build["model"]
    first, *rest = pre.get("pretokenizers") or [None]
    bytes_only = len(rest) == 1 and rest[0].get("type") == "ByteLevel" and not rest[0].get("use_regex", True) and not rest[0].get("add_prefix_space")
    plain = build["normalizer"] == WORD_NORMALIZER and first == WORD_SPLIT and bytes_only and build["decoder"] is None
    return bool(plain and model["type"] == "BPE" and not model.get("dropout") and _simple_tokens(build))


def byte_characters() -> dict[int, int]:
    """The characters that byte-level tokenizers use for bytes: printable ones stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return dict(zip(others, range(256, 256 + len(others)), strict=True))


def pre_token_ids(tokenizer: Tokenizer) -> Callable[[str], array]:
    """A function from one pre-token (normalised) to its ids, by the tokenizer's model alone."""
    tokenize, characters, decode = tokenizer.model.tokenize, byte_characters(), codecs.charmap_decode
    table = "".join(chr(characters.get(b, b)) for b in range(256))

    def ids(word: str) -> array:
        return array("i", [t.id for t in tokenize(decode(word.encode("utf-8"), "strict", table)[0])])

    return ids


def encode_each(tokenizer: Tokenizer, pieces: list[str]) -> list[array]:
    """The ids of each piece, of any kind."""
    out: list[array] = []
    for i in range(0, len(pieces), 4000):
        out += [array("i", e.ids) for e in tokenizer.encode_batch_fast(pieces[i : i + 4000], add_special_tokens=False)]
    return out


@contextlib.contextmanager
def no_collection() -> Iterator[None]:
    """Without the cyclic garbage collector, which would walk the memories again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()
