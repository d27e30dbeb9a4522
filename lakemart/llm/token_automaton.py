"""BPE encoding by a tokenization automaton.

The automaton reads tokens: a path is a tokenization that the merges would make, and no other is accepted.  It starts
as one state with a loop for each base symbol.  The gadget of a merge ``u v -> w`` makes a copy of the state behind u
without the arc v, lets all arcs u lead to the copy, and puts an arc w beside every arc u, to the state behind v as it
was.  After all merges the state depends on the last token alone, so the automaton is deterministic with one state
for each token.  States share their arcs with those they were copied from: stored are the removed arcs and the age of
each, and a transition is looked up along the parts of the two tokens.

A word has one accepted path that spells it, and the path of a prefix ends in one state, so a pass from left to right
over the word finds the path.  Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.pretokens import WORD_LEVEL, byte_symbols, usual
from lakemart.llm.texts import map_texts

NEVER = 1 << 62
#: Distinct words that a task remembers; it has the transition table to hold as well.
REMEMBERED = 400_000


class Automaton:
    """Tokens are numbers; ``merges`` lists ``(u, v, w)`` by rank, everything else is a base symbol."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.born: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.removed: dict[tuple[int, int], int] = {}
        self.table: dict[tuple[int, int], bool] = {}
        for rank, (u, v, w) in enumerate(merges):
            if w not in self.parts and self._arc(u, v):  # else no text has u before v any more
                self.removed[u, v] = rank
                self.born[w] = rank
                self.parts[w] = u, v

    def _arc(self, last: int, token: int) -> bool:
        """Whether the state behind ``last`` has an arc ``token``, by the gadgets so far."""
        left_age, left = NEVER, last
        while True:
            # The state behind a token is that of its right part as it was when the token was made.
            right_age, right = NEVER, token
            while True:
                # An arc of a token lies wherever there was one of its left part when it was made.
                removed = self.removed.get((left, right))
                if removed is not None and removed < left_age and removed <= right_age:
                    return False
                if right not in self.parts:
                    break
                right_age, right = self.born[right], self.parts[right][0]
            if left not in self.parts:
                return True
            left_age, left = self.born[left], self.parts[left][1]

    def step(self, last: int, token: int) -> bool:
        """The transition table, filled where it is used."""
        found = self.table.get((last, token))
        if found is None:
            if len(self.table) > 2 * REMEMBERED:
                self.table.clear()
            found = self.table[last, token] = self._arc(last, token)
        return found


class WordCoder:
    """Encoding and decoding with a vocabulary file of words whose last symbol is marked."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"] or model["ignore_merges"]:
            raise ValueError("not a plain BPE vocabulary")
        vocab, self.mark = model["vocab"], model["end_of_word_suffix"] or ""
        self.automaton = Automaton([(vocab[u], vocab[v], vocab[u + v]) for u, v in model["merges"]])
        byte = {c: b for b, c in enumerate(byte_symbols())}
        self.inner, self.final = {}, {}
        for token, i in vocab.items():
            last = bool(self.mark) and token.endswith(self.mark)
            if i in self.automaton.parts or len(token.removesuffix(self.mark) if last else token) == 1:
                spelled = bytes(byte[c] for c in (token.removesuffix(self.mark) if last else token))
                (self.final if last else self.inner)[spelled] = i
        if not self.mark:
            self.final = self.inner
        self.spelled = {i: s for tokens in (self.inner, self.final) for s, i in tokens.items()}
        self.reach = [{}, {}]  # by a token's last two bytes, the length of the longest such token
        for lengths, tokens in zip(self.reach, (self.inner, self.final), strict=True):
            for spelled in tokens:
                lengths[spelled[-2:]] = max(lengths.get(spelled[-2:], 1), len(spelled))
        self.library = Tokenizer.from_file(file)
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = {c: np.array([i], "<u4").tobytes() for c, i in special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.labels = {i: t.encode() for t, i in [*vocab.items(), *special.items()]}
        self.byte = byte
        self.known = Known(self)

    def word(self, spelled: bytes) -> list[int]:
        """The accepted path through one word."""
        n, step = len(spelled), self.automaton.step
        last, back = [0] * (n + 1), [0] * (n + 1)  # the last token of the path through each prefix, and where it starts
        for end in range(1, n + 1):
            tokens, lengths = (self.final, self.reach[1]) if end == n else (self.inner, self.reach[0])
            for start in range(max(0, end - lengths.get(spelled[max(0, end - 2) : end], 1)), end):
                token = tokens.get(spelled[start:end])
                if token is not None and (start == 0 or step(last[start], token)):
                    last[end], back[end] = token, start
                    break
            else:
                raise ValueError("a symbol is not in the vocabulary")
        path, end = [], n
        while end:
            path.append(last[end])
            end = back[end]
        return path[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers, no special tokens added."""
        if self.cut and any(c in text for c in self.special):
            return b"".join(self.special.get(x) or self._plain(x) for x in self.cut.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if usual(text):
            words = WORD_LEVEL.findall(text.lower())
        else:  # normal forms and classes of rare characters as the library has them
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            words = [bytes(self.byte[c] for c in w).decode("utf-8", "surrogateescape") for w, _ in pieces]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, words))

    def decode(self, ids: list[int]) -> bytes:
        """The labels of the ids in UTF-8, with a space between: the vocabulary has no decoder of its own."""
        labels = self.labels
        return b" ".join([labels[i] for i in ids])


class Known(dict):
    """The ids of each word met."""

    def __init__(self, coder: WordCoder):
        self.coder = coder

    def __missing__(self, word: str) -> bytes:
        found = self[word] = array("I", self.coder.word(word.encode("utf-8", "surrogateescape"))).tobytes()
        return found


@lru_cache(maxsize=2)
def coder(file: str) -> WordCoder:
    """One automaton for each Python worker."""
    return WordCoder(file)


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all) of each row, with n_tokens, ids (binary) and decoded (binary) of its whole text.

    NULL and empty texts have no ids.  Every row stands for itself, so repeated rows, NULL ids and further columns
    pass unchanged and an empty table gives an empty one; columns named like the new ones must not be kept.
    """

    def work(texts: list[bytes]) -> dict[str, list]:
        own = coder(tokenizer)
        ids = [own.encode(t.decode("utf-8", "replace")) for t in texts]
        decoded = [own.decode(np.frombuffer(i, "<u4").tolist()) for i in ids]
        return {"n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()), "ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.binary())}

    return map_texts(docs, text, docs.columns if keep is None else keep, work, "n_tokens bigint, ids binary, decoded binary")


def digests(docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text of each row of ``docs``."""
    return encode_decode(docs, tokenizer, text, [id_col]).select(
        F.col(id_col), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
