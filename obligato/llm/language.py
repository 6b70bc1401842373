"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language tells how far a text can be matched from any place.
A text is cut greedily into the longest phrases that occur in a language's labelled text; the
language that needs the fewest phrases, each weighed by the bits that name a place in that labelled
text, wins. The automata are built from a bounded sample of labelled rows (``DOCUMENTS`` per language, up to
``LETTERS`` of each; fewer per language where there are so many that they would be more than ``TEXTS`` in all) and
broadcast: at most 2 x TEXTS x LETTERS states. Every letter of the sample is a symbol: steps by the most frequent ones are a
dense table, those by the others a sorted list of edges, so that scripts of thousands of letters are told apart as well.

Whole texts are parsed. For speed, each text is dealt into lanes of ``LANE`` symbols that step through
the automata together; a phrase ends at a lane's end, for all languages alike.
"""

import math
import sys

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from obligato.llm.common import keep_rows, map_rows

DOCUMENTS, TEXTS, LETTERS, LANE = 40, 640, 1000, 256
#: Symbols with a column of their own: UNKNOWN, BLANK and the most frequent letters.
DENSE = 64
UNKNOWN, BLANK = 0, 1
UND = "und"


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


class SuffixAutomaton:
    """All substrings of one text over symbols below ``alphabet``, as edges: state, symbol, next state. The root is state 1."""

    def __init__(self, symbols: list[int], alphabet: int):
        nexts, link, length, last = [{}, {}], [0, 0], [0, 0], 1
        for c in symbols:
            new = len(nexts)
            nexts.append({})
            link.append(1)
            length.append(length[last] + 1)
            p = last
            while p and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p:
                q = nexts[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(nexts)
                    nexts.append(dict(nexts[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    link[q] = link[new] = copy
                    while p and nexts[p].get(c) == q:
                        nexts[p][c] = copy
                        p = link[p]
            last = new
        self.alphabet, self.states = alphabet, len(nexts)
        edges = [(state, c, to) for state, steps in enumerate(nexts) for c, to in steps.items()]
        self.state, self.symbol, self.to = np.array(edges, np.int64).reshape(-1, 3).T

    @property
    def table(self) -> np.ndarray:
        """next[state, symbol], 0 for none."""
        table = np.zeros((self.states, self.alphabet), np.int32)
        table[self.state, self.symbol] = self.to
        return table


class Model:
    """The languages' automata as edges, and how code points become symbols. A ``Parser`` makes a table of the frequent ones."""

    def __init__(self, samples: dict[str, list[str]], letters: int = LETTERS, dense: int = DENSE):
        self.languages = sorted(samples)
        seen: dict[str, int] = {}
        for texts in samples.values():
            for t in texts:
                for c in t.lower():
                    if c.isalpha():
                        seen[c] = seen.get(c, 0) + 1
        self.symbol_of_letter = {c: i + 2 for i, c in enumerate(sorted(seen, key=lambda c: (-seen[c], c)))}
        self.alphabet = len(seen) + 2
        self.dense = dense = min(dense, self.alphabet)
        lookup, self.states, self.bits, self.sizes = code_points(self.symbol_of_letter), 0, [], []
        state, symbol, to = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lang in self.languages:
            # A symbol that no text has stands between the sampled texts.
            symbols = [s for t in samples[lang] for s in [*as_symbols(t, lookup)[:letters].tolist(), UNKNOWN]]
            own = SuffixAutomaton(symbols, self.alphabet)
            known = own.symbol != UNKNOWN
            state.append(own.state[known] + self.states)
            symbol.append(own.symbol[known])
            to.append(own.to[known])
            self.sizes.append(own.states)
            self.states += own.states
            self.bits.append(math.log2(len(symbols) + 2))
        state, symbol, to = (np.concatenate(x) for x in (state, symbol, to))
        common = symbol < dense
        self.place, self.place_to = (state * dense + symbol)[common].astype(np.int32), to[common].astype(np.int32)
        edge, edge_to = (state * self.alphabet + symbol)[~common], to[~common].astype(np.int32)
        order = np.argsort(edge)
        self.edge, self.edge_to = edge[order], edge_to[order]
        #: Where each language's states begin; steps name states within their language, whose root is 1.
        self.begins, self.bits = np.cumsum([0, *self.sizes])[:-1], np.array(self.bits)


def code_points(symbol_of_letter: dict[str, int]) -> np.ndarray:
    """Symbol by code point: learned letters in either case, UNKNOWN for other letters, BLANK for the rest."""
    lookup = np.full(sys.maxunicode + 1, BLANK, np.min_scalar_type(len(symbol_of_letter) + 2))
    for c in range(sys.maxunicode + 1):
        if chr(c).isalpha():
            lookup[c] = symbol_of_letter.get(chr(c).lower(), UNKNOWN)
    return lookup


def as_symbols(text: str, lookup: np.ndarray) -> np.ndarray:
    """The text's symbols, runs of blanks as one."""
    s = lookup[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return s[np.concatenate(([True], (s[1:] != BLANK) | (s[:-1] != BLANK)))] if len(s) else s


class Parser:
    def __init__(self, model: Model):
        self.m, self.lookup = model, code_points(model.symbol_of_letter)
        # Two bytes a step where no language has more states than they can name.
        self.flat = np.zeros(max(model.states, 1) * model.dense, np.uint16 if max(model.sizes, default=0) < 1 << 16 else np.int32)
        self.flat[model.place] = model.place_to
        self.begins = model.begins[:, None]
        self.first = self.flat.reshape(-1, model.dense)[model.begins + 1] if len(model.begins) else None

    def begin(self, symbols: np.ndarray) -> np.ndarray:
        """As ``step`` from each language's root."""
        if not len(self.m.edge):
            return self.first[:, symbols]
        return self.step(np.ones((len(self.begins), len(symbols)), np.int64), symbols)

    def step(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states (languages, lanes) that each lane's symbol leads to, 0 for none."""
        m, state = self.m, state + self.begins
        if not len(m.edge):
            return self.flat[state * m.dense + symbols]
        to = self.flat[state * m.dense + np.where(symbols < m.dense, symbols, UNKNOWN)]
        rare = np.flatnonzero(symbols >= m.dense)
        if len(rare):
            edge = state[:, rare] * m.alphabet + symbols[rare]
            at = np.minimum(np.searchsorted(m.edge, edge), len(m.edge) - 1)
            to[:, rare] = np.where(m.edge[at] == edge, m.edge_to[at], 0)
        return to

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Weighed phrases per language and symbol of each text: (texts, languages)."""
        symbols = [as_symbols(t, self.lookup) for t in texts]
        starts = [(d, i) for d, s in enumerate(symbols) for i in range(0, len(s), LANE)]
        size = np.array([min(LANE, len(symbols[d]) - i) for d, i in starts], np.int64)
        order = np.argsort(-size, kind="stable")  # so that the lanes that still run stand first
        lanes = np.zeros((LANE, len(starts)), self.lookup.dtype)
        for column, k in enumerate(order):
            d, i = starts[k]
            lanes[:size[k], column] = symbols[d][i:i + LANE]
        n_lang, root = len(self.m.languages), 1
        state = np.full((n_lang, len(starts)), root, np.int64)
        count = np.zeros((n_lang, len(starts)), np.int32)
        running = np.searchsorted(-size[order], -np.arange(LANE), side="left")  # lanes longer than t
        for t in range(int(size.max(initial=0))):
            n = running[t]
            c = lanes[t, :n]
            to = self.step(state[:, :n], c)
            ended = to == 0
            count[:, :n] += ended
            again = self.begin(c)
            # A symbol that the language does not know is a phrase by itself, beside the one that it ends.
            lost = ended & (again == 0)
            if lost.any():
                count[:, :n] += lost & (state[:, :n] != root)
            state[:, :n] = np.where(ended, np.where(again == 0, root, again), to)
        count += state != root  # a phrase that is open at a lane's end
        total = np.zeros((len(texts), n_lang))
        np.add.at(total, np.array([starts[k][0] for k in order], np.int64), count.T)
        return total * self.m.bits / np.array([max(1, len(s)) for s in symbols])[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and confidence (0 to 1: by how much the runner-up needs more); ``und`` for a text without a letter."""
        langs, scores = [UND] * len(texts), [0.0] * len(texts)
        use = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.m.languages else []
        if use:
            for i, costs in zip(use, self.phrases([texts[i] for i in use])):
                best = int(costs.argmin())
                langs[i] = self.m.languages[best]
                others = np.delete(costs, best)
                scores[i] = float(1 - costs[best] / others.min()) if len(others) else 1.0
        return langs, scores


def learn(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learns from a bounded sample of distinct labelled texts: those of each language with the smallest text hashes.

    ``DOCUMENTS`` of each language, or as many as ``TEXTS`` allow for each; of more languages than that, those with the most
    texts are learned. Null texts, languages and ids are not used, repeated texts count once; without rows nothing is learned.
    """
    rows = docs.where(~held_out(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    common = rows.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(TEXTS)
    languages = [r.lang for r in common.collect()]
    each = max(1, min(DOCUMENTS, TEXTS // max(len(languages), 1)))
    firsts = Window.partitionBy("lang").orderBy("h")
    chosen = (rows.where(F.col("lang").isin(languages)).groupBy("lang", "h").count().withColumn("rank", F.row_number().over(firsts))
              .where(F.col("rank") <= each).select("lang", "h").collect())
    wanted = {(r.lang, r.h) for r in chosen}
    # One text per chosen hash, no longer than the sample can use.
    texts = (rows.where(F.col("h").isin([h for _, h in wanted])).groupBy("lang", "h")
             .agg(F.min(F.substring("text", 1, 4 * LETTERS)).alias("text")).collect())
    samples: dict[str, list[str]] = {}
    for r in sorted(texts, key=lambda r: (r.lang, r.h)):
        if (r.lang, r.h) in wanted and any(map(str.isalpha, r.text)):
            samples.setdefault(r.lang, []).append(r.text)
    return Model(samples)


def identify(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter are ``und`` with score 0; ties go to the first language by
    name; with a single learned language the score is 1, with none all rows are ``und``. Null ids and
    repeated rows stay; other columns (a clashing ``score`` too) are not read; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        parser = Parser(shared.value)

        def work(rows):
            langs, scores = parser.predict(rows["text"])
            return {"doc_id": rows["doc_id"], "held_out": rows["held"], "lang_pred": langs, "score": scores}

        return work

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out(F.col(doc_id)).alias("held"))
    return map_rows(rows, {"doc_id": "long", "held_out": "boolean", "lang_pred": "string", "score": "double"}, make)


def keep_identified(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The documents, all columns unchanged, whose language is found; those that come out as ``und`` go.

    Null texts and texts without a letter go, null ids and repeated rows stay; columns may have any name; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        parser = Parser(shared.value)
        return lambda rows: [lang != UND for lang in parser.predict(rows[text])[0]]

    return keep_rows(docs, make)
