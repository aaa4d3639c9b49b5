"""Token counts (operator 10) and the token ids that packing uses.

Counting: texts reach Python in Arrow batches and only lengths go back.
A batch is worked through in groups of about ``GROUP_BYTES`` bytes, so
one call never holds more, however long the texts are.  A text is split
at safe boundaries: a space after a character other than a space.  No
piece of the vocabulary goes on over such a boundary (checked when the
model is loaded), so the counts of the parts add up to the count of the
whole text, and a part that comes again is looked up.

Nulls count as empty texts; an empty text has no token.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import fresh, quoted

#: Bytes of text handled by one call into the tokenizer library.
GROUP_BYTES = 1 << 20
#: Parts remembered per Python worker (cleared when full), and the longest part worth it.
REMEMBERED = 600_000
LONGEST_REMEMBERED = 64
#: A text above this many characters is split before its parts are gathered.
LONG_TEXT = 1 << 18
_PART = re.compile(" *[^ ]+| +")
_CUT = re.compile("[^ ] (?=[^ ])")


def groups_by_bytes(texts: Iterable[str | None], size: int = GROUP_BYTES) -> Iterator[list[str]]:
    """Consecutive texts, each group of about ``size`` bytes, never empty."""
    group, held = [], 0
    for t in texts:
        t = t or ""
        n = utf8_size(t)
        if group and held + n > size:
            yield group
            group, held = [], 0
        group.append(t)
        held += n
    if group:
        yield group


def utf8_size(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


class PieceCounter:
    """Counts tokens of a sentencepiece model over parts between safe boundaries."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.known: dict[str, int] = {}
        self.safe = self._boundaries_are_safe(path)

    @staticmethod
    def _boundaries_are_safe(path: str) -> bool:
        """No normalisation, a leading space added, and no piece with a space after another character."""
        from sentencepiece import sentencepiece_model_pb2 as schema

        spec = schema.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        n = spec.normalizer_spec
        plain = (n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces
                 and not n.precompiled_charsmap and not spec.trainer_spec.treat_whitespace_as_suffix)
        return plain and not any(re.search("[^▁]▁", p.piece) for p in spec.pieces)

    @staticmethod
    def _parts(text: str) -> tuple[list[str], int]:
        """Parts whose encodings, each with the leading space the model adds,
        add up to the text's, and the tokens to add for a lone space at the end."""
        if "▁" in text:
            return [text], 0                   # the model's own space mark: leave it whole
        if "  " not in text and text[:1] != " " and text[-1:] != " ":
            return (text.split(" ") if text else []), 0
        found = _PART.findall(text)
        # the model puts a space before the first part; the others bring their own
        rest = [p[1:] for p in found[1:]]
        lone = bool(rest) and not rest[-1]
        return found[:1] + (rest[:-1] if lone else rest), int(lone)

    def counts(self, texts: list[str]) -> list[int]:
        """Token counts of the texts of one group."""
        if not self.safe:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        out = [0] * len(texts)
        for i, text in enumerate(texts):
            for some in segments(text):
                parts, lone = self._parts(some)
                new = [*set(parts).difference(self.known)]
                if len(new) + len(self.known) > REMEMBERED:
                    self.known.clear()
                    new = [*set(parts)]
                self.known.update(zip(new, map(len, self.model.encode(new, num_threads=1))))
                out[i] += sum(map(self.known.__getitem__, parts)) + lone
                for part in new:                     # so REMEMBERED bounds the bytes too
                    if len(part) > LONGEST_REMEMBERED:
                        del self.known[part]
        return out


def segments(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """A long text in parts of about ``size`` characters, cut at single spaces.

    The space at a cut belongs to neither side: the model adds it again.
    """
    a = 0
    while len(text) - a > size:
        cut = _CUT.search(text, a + size - 1)
        if not cut or "▁" in text:
            break
        yield text[a:cut.start() + 1]
        a = cut.start() + 2
    yield text[a:] if a else text


@lru_cache(maxsize=4)
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(col: Column, path: str) -> Column:
    """Tokens of a text column under the sentencepiece model at ``path``."""
    @F.arrow_udf("long")
    def run(text: pa.Array) -> pa.Array:
        counter = piece_counter(path)
        out: list[int] = []
        for group in groups_by_bytes(text.to_pylist()):
            out += counter.counts(group)
        return pa.array(out, pa.int64())
    return run(col)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """``docs`` plus n_bytes, n_tokens and over_limit (n_tokens above ``limit``).

    The names are changed by a trailing underscore where ``docs`` has them.
    """
    n_bytes, n_tokens, over = fresh(docs, "n_bytes", "n_tokens", "over_limit")
    text = F.coalesce(quoted("text"), F.lit(""))
    return (docs.withColumn(n_bytes, F.octet_length(text).cast("long"))
            .withColumn(n_tokens, token_counts(quoted("text"), path))
            .withColumn(over, F.col(n_tokens) > limit))


# ---- ids of a byte-level vocabulary ---------------------------------------

#: Beyond these code points the two libraries' Unicode tables could differ.
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


class ByteIds:
    """Ids of a byte-level BPE vocabulary as the tokenizers library gives them.

    ``path`` is the library's JSON file.  Where ``ranks`` names the same
    vocabulary as a rank file, Latin texts go through tiktoken, which gives
    the same ids several times as fast; all other texts, and all texts
    without a rank file, go through tokenizers.
    """

    def __init__(self, path: str, ranks: str | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.fast = None
        self.splits = plain_byte_level(path)
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
            if same_vocabulary(path, table):
                self.fast = tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=table,
                                              special_tokens=special)

    def array(self, text: str, kind: str) -> np.ndarray:
        """The ids of a whole text as an array; a long text is encoded part by part."""
        parts = [np.array(self.ids(some), kind) for some in (safe_parts(text) if self.splits else (text,))]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and not _BEYOND_LATIN.search(text):
            return self.fast.encode(text, allowed_special="all")
        return self.library.encode(text, add_special_tokens=False).ids


def safe_parts(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """A long text in parts of about ``size`` characters, cut where the split rule always cuts:
    before a space that follows a letter and precedes one."""
    a = 0
    while len(text) - a > size:
        cut = _LETTERS.search(text, a + size - 1)
        if not cut:
            break
        yield text[a:cut.start() + 1]
        a = cut.start() + 1
    yield text[a:]


_LETTERS = re.compile("[A-Za-z] (?=[A-Za-z])")


def plain_byte_level(path: str) -> bool:
    """Whether a tokenizer file splits by the byte-level rule alone, with added tokens that hold no space."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec["pre_tokenizer"] or {}
    return (split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
            and spec["normalizer"] is None and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                        for t in spec["added_tokens"]))


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in such files: printable bytes for themselves, the others from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = (b for b in range(256) if b not in printable)
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


def same_vocabulary(path: str, ranks: dict[bytes, int]) -> bool:
    """Whether a tokenizer file and a rank table hold the same tokens, ids and order of merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, model = byte_letters(), spec["model"]
    added = {t["content"] for t in spec["added_tokens"]}
    tokens = {t: i for t, i in model["vocab"].items() if t not in added}
    if not plain_byte_level(path) or any(c not in letters for t in tokens for c in t):
        return False
    if {bytes(letters[c] for c in t): i for t, i in tokens.items()} != ranks:
        return False
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merged = [tokens.get("".join(pair)) for pair in pairs]
    return None not in merged and all(a < b for a, b in zip(merged, merged[1:])) and not model.get("ignore_merges")


#: Fixed value: the split pattern of byte-level vocabularies, in possessive form.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@lru_cache(maxsize=4)
def byte_ids(path: str, ranks: str | None) -> ByteIds:
    return ByteIds(path, ranks)
