"""Secrets in texts: fixed patterns, and character Markov models for the rest. DataFrame functions only.

Two first-order character chains are trained from labelled samples: random strings (those that the
patterns found, and generated ones in hexadecimal, base-64 and alphanumeric letters) and ordinary identifiers
(words, numbers and paths of the texts that no pattern found, and names made of programming words in the usual
styles, dates, keyboard rows and repeated letters). Runs of identifier characters outside
the patterns' spans are searched for stretches whose log-likelihood ratio favours the random chain by
``MIN_EVIDENCE``; each, widened to the separators ``/ = _ -`` around it, is a secret of kind ``random``.
The models are a table of 128 x 128 ratios, a literal of the plan.

Ordinary steps count as ``ORDINARY_STEPS`` per source and character at most, however large the sample is: a step that the
texts' own languages lack is then mild evidence, so that names of other languages are no secrets.

No array or text grows by one item at a time, so that the work on a text follows its length, not the square of its matches.
"""

import json
import math
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from obligato.llm.common import whole_row

KINDS = ["assign", "access", "hex", "random"]
# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # leftmost runs are maximal, so this finds the runs of [0-9a-f]+ that are long enough
ASSIGN_VALUE_CHARS, ACCESS_CHARS = 12, 18

#: Shorter runs have too few steps for the evidence.
RUN = r"[A-Za-z0-9+/_=-]{8,}"
WORD = r"[A-Za-z0-9+/_=-]{6,}"
#: Evidence in natural-log units: a stretch must be e^12 times likelier under the random chain.
MIN_EVIDENCE = 12.0
SAMPLE_DOCUMENTS, GENERATED, NAMES, ORDINARY_STEPS = 1500, 1500, 6000, 150
_ALPHABET = 65  # letters of either case, digits and + / _ = - less the padding sign, for smoothing
REPLACEMENT = "[SECRET]"

# Words that names of programs are made of, and rows of keyboards and alphabets.
_NAME_WORDS = """
    get set element class name request response factory bean string buffer reader writer http xml json html url api user admin
    account manager service controller handler listener event config settings default value index count total length width height
    size color background border margin button image window document node parent child first last next previous start end begin
    finish open close read write load save update delete create insert remove append find search replace match test check valid
    error exception message warning debug info log file path folder system process thread task queue stack list map table row
    column key data base model view template session cookie header body content type format version release build server client
    host port address network connection timeout example local internal public private static abstract interface by id is has to
    of with for on sql db utf auth""".split()
_ROWS = [string.ascii_lowercase, "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop", "0123456789", "1234567890", "9876543210"]

_SPAN = "array<struct<start:int,end:int>>"


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once; what is named inside a lambda is worked out for each item."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running totals (from 0, of integers) by an associative function, one for each value.

    A fold that appends copies its array each time. So the values are folded in about as many blocks as a block has values:
    n of them cost n times the root of n copied integers at most.
    """
    def scan(block: Column, start: Column) -> Column:
        return F.aggregate(block, F.array(start).cast("array<int>"), lambda all_, v: F.concat(all_, F.array(combine(F.element_at(all_, -1), v))))

    def in_blocks(width: Column, all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / width).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_, b * width + 1, width))

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), combine))
        starts = scan(F.slice(totals, F.lit(1), F.size(totals) - 1), F.lit(0))
        return F.flatten(F.zip_with(blocks, starts, lambda block, start: F.slice(scan(block, start), F.lit(2), F.size(block))))

    def whole(all_: Column) -> Column:
        return _let(_let(F.ceil(F.sqrt(F.size(all_))).cast("int"), lambda width: in_blocks(width, all_)), joined)

    return _let(values, lambda all_: F.when(F.size(all_) > 0, whole(all_)).otherwise(F.array().cast("array<int>")))


def _placed(text: Column, pattern: str, matches: Column) -> Column:
    """Start and end (code points) of all matches: they lie between the pieces that a split leaves."""
    def spans(found: Column) -> Column:
        lengths = F.transform(found, F.length)
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(found))
        ends = _running(F.zip_with(gaps, lengths, lambda gap, length: gap + length), lambda at, step: at + step)
        return F.zip_with(ends, lengths, lambda end, length: F.struct((end - length).alias("start"), end.alias("end")))

    return _let(matches, lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(F.array().cast(_SPAN)))


def _cut(text: Column, spans: Column, instead: Callable[[Column, Column], Column]) -> Column:
    """The text with something else in the place of its spans (sorted by start; they may overlap).

    ``instead`` gets a span and where the spans before it end. Pieces are cut from the text's UTF-32 form, where every
    code point has its place, and joined at once.
    """
    def piece(code: Column, start: Column, end: Column) -> Column:
        # With a mark of order in front, the text's own ones stay.
        part = F.concat(F.unhex(F.lit("0000FEFF")), F.substring(code, start * 4 + 1, (end - start) * 4))
        return F.when(end > start, F.decode(part, "UTF-32")).otherwise(F.lit(""))

    def pieces(code: Column, own: Column, reached: Column) -> Column:
        def step(span: Column, i: Column) -> Column:
            return _let(F.when(i == 0, F.lit(0)).otherwise(F.get(reached, i - 1)), lambda before: F.concat(
                piece(code, before, span["start"]), instead(span, before)))

        rest = piece(code, F.element_at(reached, -1), F.floor(F.octet_length(code) / 4).cast("int"))
        return F.concat(F.array_join(F.transform(own, step), ""), rest)

    def cut(own: Column) -> Column:
        reached = _running(F.transform(own, lambda span: span["end"]), lambda at, end: F.greatest(at, end))
        return _let(reached, lambda r: _let(F.encode(text, "UTF-32"), lambda code: pieces(code, own, r)))

    return _let(spans, lambda own: F.when(F.size(own) > 0, cut(own)).otherwise(text))


def with_base_spans(rows: DataFrame) -> DataFrame:
    """Rows with ``t`` (text, not null) and the patterns' spans: assign, access, hex, each array<struct<start, end>>."""
    none = F.array().cast("array<string>")
    t = F.col("t")
    assign_text = t.contains(":") | t.contains("=")
    rows = rows.select(
        "*",
        F.when(assign_text, _found(t, ASSIGN)).otherwise(none).alias("_assign"),
        F.when(assign_text, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))).otherwise(none).alias("_values"),
        F.when(t.contains("AKIA"), _found(t, ACCESS)).otherwise(none).alias("_access"),
        _found(t, HEX).alias("_hex"))
    rows = rows.select("*", *[_placed(t, pattern, F.col(f"_{kind}")).alias(kind) for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))])
    # Matches that fail their length are dropped after the search: they have used up their text.
    long_value = F.zip_with("assign", "_values", lambda s, value: F.when(F.length(value) >= ASSIGN_VALUE_CHARS, s))
    long_key = F.filter("access", lambda s: s["end"] - s["start"] >= ACCESS_CHARS)
    return rows.withColumns({"assign": F.filter(long_value, lambda s: s.isNotNull()), "access": long_key}).drop("_assign")


def _steps(run: Column) -> Column:
    """Pairs of neighbouring characters as a * 128 + b."""
    chars = F.split(run, "")
    n = F.length(run) - 1
    return F.zip_with(F.slice(chars, 1, n), F.slice(chars, 2, n), lambda a, b: F.ascii(a) * 128 + F.ascii(b))


def _names(spark) -> DataFrame:
    """s: names of one to four programming words in the styles of identifiers, some with a number; the same ones every time."""
    def drawn(what: str, n: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(what)), F.lit(n)).cast("int")

    words = F.array(*map(F.lit, _NAME_WORDS))
    parts = F.array(*[F.get(words, drawn(f"word{k}", len(_NAME_WORDS))) for k in range(4)])
    rows = spark.range(NAMES).select("id", F.slice(parts, F.lit(1), drawn("parts", 4) + 1).alias("parts"), drawn("style", 6).alias("style"))
    capital = F.array_join(F.transform("parts", F.initcap), "")
    shouted = F.array_join(F.transform("parts", lambda p, i: F.when((drawn("shout", 8) + i) % 3 == 0, F.upper(p)).otherwise(F.initcap(p))), "")
    name = (F.when(F.col("style") == 0, F.concat(F.element_at("parts", 1), F.substr(capital, F.length(F.element_at("parts", 1)) + 1)))
            .when(F.col("style") == 1, capital).when(F.col("style") == 2, F.array_join("parts", "_"))
            .when(F.col("style") == 3, F.upper(F.array_join("parts", "_"))).when(F.col("style") == 4, F.array_join("parts", "-"))
            .otherwise(shouted))
    numbered = F.concat(name, F.when(drawn("numbered", 3) == 0, drawn("number", 3000).cast("string")).otherwise(F.lit("")))
    dates = spark.range(0, 16_000, 9).select(F.explode(F.array(*[
        F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), f) for f in ("yyyyMMdd", "yyyy-MM-dd")])).alias("s"))
    plain = [row for line in _ROWS for row in (line, line.upper())] * 20 + [c * 16 for c in string.ascii_letters + string.digits] * 4
    return rows.select(numbered.alias("s")).unionByName(dates).unionByName(spark.createDataFrame([(p,) for p in plain], "s string"))


def _labelled_strings(docs: DataFrame) -> DataFrame:
    """s, source (random, words, names): the labelled sample, from a bounded number of documents.

    An id that stands in several rows gives one text, the least, so that a repeated id cannot fill the sample.
    """
    spark = docs.sparkSession
    chosen = [r.doc_id for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().orderBy("h", "doc_id").limit(SAMPLE_DOCUMENTS).collect()]
    texts = docs.where(F.col("doc_id").isin([i for i in chosen if i is not None])).groupBy("doc_id").agg(F.min("text").alias("text"))
    sampled = with_base_spans(texts.select(F.coalesce("text", F.lit("")).alias("t")))
    values = F.concat(F.filter("_values", lambda v: F.length(v) >= ASSIGN_VALUE_CHARS), F.filter("_access", lambda v: F.length(v) >= ACCESS_CHARS), "_hex")
    words = F.array_distinct(_found(_outside_base(F.col("t")), WORD))
    n = F.col("id").cast("string").cast("binary")
    digests = spark.range(GENERATED).select(F.sha2(n, 256).alias("hex"), F.base64(F.unhex(F.sha2(n, 384))).alias("base64"))
    made = digests.select(F.explode(F.array("hex", "base64", F.regexp_replace("base64", "[+/]", ""), F.upper(F.regexp_replace("base64", "[+/]", "")))).alias("s"))

    def labelled(rows: DataFrame, source: str) -> DataFrame:
        return rows.select("s", F.lit(source).alias("source"))

    return (labelled(sampled.select(F.explode(words).alias("s")), "words").unionByName(labelled(_names(spark), "names"))
            .unionByName(labelled(sampled.select(F.explode(values).alias("s")), "random")).unionByName(labelled(made, "random")))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of each character step, by a * 128 + b, from rows (doc_id, text).

    Null ids are not sampled, null texts have nothing; without documents the generated strings and names alone are learned from.
    """
    steps = _labelled_strings(docs).select("source", F.explode(_steps(F.col("s"))).alias("step")).groupBy("source", "step").count().collect()
    counts = {source: [0.0] * 128 ** 2 for source in ("random", "words", "names")}
    for r in steps:  # at most 3 x 128 x 128 rows
        counts[r.source][r.step] = float(r["count"])
    ratios = []
    for a in range(128):
        rows = {source: c[a * 128:a * 128 + 128] for source, c in counts.items()}
        parts = {source: min(1.0, ORDINARY_STEPS / max(sum(rows[source]), 1.0)) for source in ("words", "names")}
        ordinary = [sum(rows[source][b] * part for source, part in parts.items()) for b in range(128)]
        both = [[(c + 0.5) / (sum(row) + 0.5 * _ALPHABET) for c in row] for row in (rows["random"], ordinary)]
        ratios += [round(math.log(r / o), 6) for r, o in zip(*both)]
    return ratios


def _outside_base(text: Column) -> Column:
    """The text with blanks in place of the patterns' spans."""
    base = F.sort_array(F.concat("assign", "access", "hex"))
    return _cut(text, base, lambda s, before: F.repeat(F.lit(" "), F.greatest(s["end"], before) - F.greatest(s["start"], before)))


def _has_stretch(steps: Column, table: Column) -> Column:
    """Whether any stretch of steps (maximum sum) has the evidence."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(state: Column, s: Column) -> Column:
        total = F.greatest(state["sum"] + F.element_at(table, s + 1), F.lit(0.0))
        return F.struct(total.alias("sum"), F.greatest(state["best"], total).alias("best"))

    return F.aggregate(steps, start, step, lambda state: state["best"] >= MIN_EVIDENCE)


def _stretches(steps: Column, table: Column) -> Column:
    """Start and end (characters of the run) of all stretches with the evidence, apart from each other.

    A stretch ends at its best sum, once the sum has fallen to 0 or by as much as the evidence asks for.
    """
    none = F.array().cast(_SPAN)
    start = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0).alias("start"), F.lit(0.0).alias("best"), F.lit(0).alias("end"), none.alias("found"))

    def found(state: Column) -> Column:
        own = F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))
        return F.when(state["best"] >= MIN_EVIDENCE, F.concat(state["found"], own)).otherwise(state["found"])

    def step(state: Column, s: Column) -> Column:
        total = state["sum"] + F.element_at(table, s + 1)
        over = (total <= 0) | (total <= state["best"] - MIN_EVIDENCE)
        better = total > state["best"]
        return F.struct(
            (state["at"] + 1).alias("at"), F.when(over, 0.0).otherwise(total).alias("sum"),
            F.when(over, state["at"] + 1).otherwise(state["start"]).alias("start"),
            F.when(over, 0.0).when(better, total).otherwise(state["best"]).alias("best"),
            F.when(better, state["at"] + 2).otherwise(state["end"]).alias("end"),
            F.when(over, found(state)).otherwise(state["found"]).alias("found"))

    return F.aggregate(steps, start, step, found)


def _widened(run: Column, s: Column) -> Column:
    """The stretch with the whole of each piece between separators of which it holds half or more, and a run's padding."""
    inner, rest = F.substr(run, s["start"] + 1, s["end"] - s["start"]), F.substr(run, s["end"] + 1, F.length(run))
    length = lambda text, pattern, group=0: F.length(F.regexp_extract(text, pattern, group))
    before, first = length(F.substr(run, F.lit(1), s["start"]), "[^/=_-]*$"), length(inner, "^[^/=_-]*")
    last, after, padding = length(inner, "[^/=_-]*$"), length(rest, "^[^/=_-]*"), length(rest, "^[^/=_-]*(=*)$", 1)
    single = first == F.length(inner)
    start = F.when(single | (first >= before), s["start"] - before).otherwise(s["start"] + first + 1)
    end = F.when(single | (last >= after), s["end"] + after + padding).otherwise(s["end"] - last - 1)
    return F.when(start < end, F.struct(start.alias("start"), end.alias("end"))).otherwise(s)


def _merged(spans: Column) -> Column:
    """Spans sorted by start, those that overlap as one."""
    def step(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        both = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(both))
        return F.when(F.size(done) == 0, F.array(s)).when(s["start"] < last["end"], joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.sort_array(spans), F.array().cast(_SPAN), step)


def with_spans(rows: DataFrame, ratios: list[float]) -> DataFrame:
    """Rows (with ``t``) and their spans of all kinds: assign, access, hex, random."""
    rows = with_base_spans(rows).drop("_values", "_access", "_hex")
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    rows = rows.withColumn("_outside", _outside_base(F.col("t")))
    rows = rows.withColumn("_runs", _found(F.col("_outside"), RUN))
    # Of each run, what lies before it; only runs with a stretch are kept apart, so that long texts stay cheap.
    gaps = F.transform(F.split("_outside", RUN, -1), lambda piece: F.length(piece))
    rows = rows.withColumn("_items", F.zip_with(F.slice(gaps, F.lit(1), F.size("_runs")), "_runs", lambda gap, run: F.struct(
        gap.alias("gap"), F.length(run).alias("length"), F.when(_has_stretch(_steps(run), table), run).alias("run"))))

    def hits(items: Column) -> Column:
        ends = _running(F.transform(items, lambda item: item["gap"] + item["length"]), lambda at, step: at + step)
        placed = F.zip_with(items, ends, lambda item, end: F.struct((end - item["length"]).alias("start"), item["run"].alias("run")))
        return F.filter(placed, lambda hit: hit["run"].isNotNull())

    # Most texts have runs but no stretch; their runs need no places.
    none = F.array().cast("array<struct<start:int,run:string>>")
    rows = rows.withColumn("_hits", _let(F.col("_items"), lambda items: F.when(
        F.exists(items, lambda item: item["run"].isNotNull()), hits(items)).otherwise(none)))

    def spans(hit: Column) -> Column:
        own = _merged(F.transform(_stretches(_steps(hit["run"]), table), lambda s: _widened(hit["run"], s)))
        return F.transform(own, lambda s: F.struct((s["start"] + hit["start"]).alias("start"), (s["end"] + hit["start"]).alias("end")))

    return rows.withColumn("random", F.flatten(F.transform("_hits", spans))).drop("_outside", "_runs", "_items", "_hits")


def in_order(*kinds: str) -> Column:
    """All spans of the kinds, by start, then kind as listed: array<struct<start, kind, end>>."""

    def numbered(kind: str) -> Column:
        number = F.lit(KINDS.index(kind)).alias("kind")
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), number, s["end"].alias("end")))

    return F.sort_array(F.concat(*map(numbered, kinds)))


def as_string(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, ratios: list[float] | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, one row per input row.

    Places are code points of the whole text, end exclusive. Null and empty texts have no spans (the
    digest is that of an empty string); null ids and repeated rows stay; other columns are not read; no rows give no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ratios = ratios if ratios is not None else train(rows)
    found = with_spans(rows.select("doc_id", F.coalesce("text", F.lit("")).alias("t")), ratios).drop("t")
    found = found.withColumns({"_base": in_order(*KINDS[:3]), "_all": in_order(*KINDS)})
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(as_string(F.col("_base")), 256).alias("base_sha256"), as_string(F.col("_all")).alias("spans"))


def redact(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """The documents with each stretch of secrets replaced by ``REPLACEMENT`` and n_chars of the new text.

    Texts without a secret, null texts and all other columns stay as they are; repeated rows and null ids stay; columns may have
    any name; no rows give no rows.
    """
    ratios = ratios if ratios is not None else train(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = with_spans(docs.select(whole_row(docs).alias("_row"), F.coalesce("text", F.lit("")).alias("t")), ratios)
    rows = rows.withColumn("_spans", in_order(*KINDS))
    # A span that begins within what is already replaced only extends it.
    replaced = _cut(F.col("t"), F.col("_spans"), lambda s, before: F.when((s["start"] >= before), F.lit(REPLACEMENT)).otherwise(F.lit("")))
    rows = rows.withColumn("_new", F.when(F.size("_spans") > 0, replaced))
    new = F.coalesce("_new", F.col("_row.text"))
    out = []
    for f in docs.schema.fields:
        if f.name == "text":
            out.append(new.alias("text"))
        elif f.name == "n_chars":
            out.append(F.when(F.col("_new").isNull(), F.col("_row.n_chars")).otherwise(F.length(new)).cast(f.dataType).alias("n_chars"))
        else:
            out.append(F.col("_row")[f.name].alias(f.name))
    return rows.select(*out)
