"""Exact token counts at every prefix of a text, by dynamic programming over its prefixes.

For BPE, a sequence of tokens is the encoding of its text exactly when every two neighbours are the
encoding of their joined text. So the last token of a prefix follows from the last tokens of the
shorter prefixes: it is the one token that ends there and agrees with the last token of the prefix
before it; and count(prefix) = count(prefix without that token) + 1. One pass gives the counts of all
prefixes, and questions about truncation or budgets are look-ups, without encoding again.

No token of the vocabulary holds a blank after another character, so blanks start independent
units; the prefix counts of each distinct unit are worked out once.
"""

import functools
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame

from obligato.llm.common import ids_and_texts, map_rows

PIECE_VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
REMEMBERED_UNITS = 1_000_000
REMEMBERED_PAIRS = 1_000_000

_BLANK = "▁"  # a fixed value of the vocabulary: how pieces show a blank


class PrefixCounter:
    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(library.get_piece_size())
                  if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        self._score = {library.id_to_piece(i): library.get_score(i) for i in normal}
        self._longest = max(map(len, self._score))
        if any(_BLANK in p.lstrip(_BLANK) for p in self._score):
            raise ValueError("a piece holds a blank after another character; units would not be independent")
        if any(c not in self._score for p in self._score for c in p):
            raise ValueError("a piece holds a character that is no piece; such a character could merge")
        #: Whether a token may follow another (or, at "", stand first), and how many such answers are held.
        self._valid: dict[str, dict[str, bool]] = {}
        self._pairs = 0
        self._units: dict[str, bytes] = {}

    def _merged(self, text: str) -> list[str]:
        """Plain BPE of a short text: the best pair first, the leftmost of equals."""
        parts, get, none = list(text), self._score.get, -np.inf
        pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def _follows(self, before: str, token: str) -> bool:
        agrees = self._merged(before + token) == ([before, token] if before else [token])
        self._valid[before][token] = agrees
        self._pairs += 1
        return agrees

    def _learn(self, keys: list[str]) -> None:
        """For each unit, by how much the count changes when the prefix grows by each of its characters (int8).

        Units are taken in order, so that one starts from what it has in common with the one before it.
        """
        score, longest, valid = self._score, self._longest, self._valid
        size = max(map(len, keys), default=0) + 2
        before, last, count, after = "", [""] * size, [0] * size, [valid.setdefault("", {})] * size
        for unit, key in sorted((key if key[:1] == _BLANK else _BLANK + key, key) for key in keys):
            same, most = 0, min(len(before), len(unit))
            while same < most and before[same] == unit[same]:
                same += 1
            for end in range(same + 1, len(unit) + 1):
                for start in range(end - longest if end > longest else 0, end):
                    token = unit[start:end]
                    if token in score:
                        agrees = after[start].get(token)
                        if agrees or agrees is None and self._follows(last[start], token):
                            count[end] = count[start] + 1
                            break
                else:  # a character without a piece merges with nothing and is written as its UTF-8 bytes
                    token = unit[end - 1]
                    count[end] = count[end - 1] + len(token.encode())
                last[end] = token
                after[end] = valid.get(token) or valid.setdefault(token, {})
            before = unit
            self._units[key] = bytes([(b - a) % 256 for a, b in zip(count, count[1:len(unit) + 1])])

    def steps_many(self, texts: list[str | None]) -> list[bytes]:
        """Per code point of each text, the change of the token count (int8); their running sum is the count at each prefix."""
        if len(self._units) > REMEMBERED_UNITS:
            self._units.clear()
        if self._pairs > REMEMBERED_PAIRS:
            self._valid, self._pairs = {}, 0
        cut = [_keys_of(t) for t in texts]
        self._learn(list(set().union(*cut) - self._units.keys()))
        out = []
        for keys in cut:
            joined = b"".join(map(self._units.__getitem__, keys))
            if joined:
                # The library puts one blank before the text. It is no prefix of its own: its count belongs to the first code point.
                joined = bytes([(joined[0] + joined[1]) % 256]) + joined[2:]
            out.append(joined)
        return out

    def steps(self, text: str | None) -> bytes:
        return self.steps_many([text])[0]


def _keys_of(text: str | None) -> list[str]:
    """The text's units: a blank starts one if it follows another character. Units with a single blank go by their word alone."""
    if not text:
        return []
    if "  " not in text and _BLANK not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    out, run = [], 0
    for part in (_BLANK + text.replace(" ", _BLANK)).split(_BLANK)[1:]:
        run += 1
        if part:
            out.append(_BLANK * run + part)
            run = 0
    return [*out, _BLANK * run] if run else out


@functools.cache
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def counts(steps: bytes) -> np.ndarray:
    """counts[i]: the tokens of the first i code points."""
    return np.concatenate(([0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)))


def longest_within(steps: bytes, limit: int) -> int:
    """Code points of the longest prefix that has at most ``limit`` tokens."""
    return int(np.flatnonzero(counts(steps) <= limit)[-1])


def prefix_counts(docs: DataFrame, path: str | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, prefix_steps: the stored counts of all prefixes, one byte per code point.

    Null and empty texts have no prefixes but the empty one (count 0). Null ids and repeated rows stay; other
    columns are not read; texts may be of any length; no rows give no rows.
    """
    return _per_text(docs, path, {"prefix_steps": "binary"}, lambda steps: [steps], doc_id, text)


def count_tokens(docs: DataFrame, limit: int = LIMIT, path: str | None = None, *, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (code points of the longest prefix within the limit).

    All three answers come from the prefix counts. Edge cases as in ``prefix_counts``.
    """

    def answers(steps: bytes) -> list:
        n = int(np.frombuffer(steps, np.int8).sum(dtype=np.int64))
        # Counts may fall by a merge, so only a text of few code points is known to fit without a look.
        return [n, n > limit, len(steps) if n <= limit else longest_within(steps, limit)]

    return _per_text(docs, path, {"n_tokens": "long", "over_limit": "boolean", "fit_chars": "long"}, answers, doc_id, text)


def _per_text(docs: DataFrame, path: str | None, schema: dict[str, str], answers: Callable[[bytes], list], doc_id: str,
              text: str) -> DataFrame:
    path = path or public_tokenizers.path(PIECE_VOCABULARY)

    def make():
        counter = prefix_counter(path)

        def work(rows):
            found = list(map(answers, counter.steps_many(rows["text"])))
            columns = dict(zip(schema, map(list, zip(*found)))) if found else {name: [] for name in schema}
            return {"doc_id": rows["doc_id"], "n_bytes": [len((t or "").encode()) for t in rows["text"]], **columns}

        return work

    return map_rows(ids_and_texts(docs, doc_id, text), {"doc_id": "long", "n_bytes": "long", **schema}, make)
