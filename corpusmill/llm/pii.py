"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Every text is searched for the four base kinds. Each whole match is remembered with the
words before it as a seed of its kind; so are runs of tokens that look like identifiers
(with a digit, an at sign or an underscore) and that no match touches, as candidates. Spark
builds the graph of lexical patterns and instances and scores both sides in turn: a pattern
that surrounds enough seeds is worth the share of its occurrences that are worthy
instances, an instance what its patterns say together. An instance that confident patterns
surround counts as a seed from then on, so it brings in patterns that no base match has.
Such instances become spans of the kind ``context``, beside the base spans, which always stay.

Defined results: a NULL text is empty; NULL ids and repeated rows are each answered; a
text without matches has zero counts and an empty list; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.slices import slices
from corpusmill.plans.staging import stage

# The patterns of the base kinds, in the order of their spans.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "context")
_COMPILED = {k: re.compile(p) for k, p in PATTERNS.items()}
# A match of these begins where a run of its characters begins, or fails from all of the run.
_COMPILED["ip"] = re.compile("(?<![0-9])" + PATTERNS["ip"])
_MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+")
_NEEDED = {"email": "@", "ip": ".", "phone": "+"}
_DIGIT = re.compile("[0-9]")
# A token with a digit, an at sign or an underscore; what follows is cut from its end.
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@_]*+[0-9@_]\S*")
_TRAILING = ".,;:!?)\"']"
_CLAUSE = ".,;:!?"
MIN_TOKEN = 6
ROUNDS = 4
MIN_SEEDS = 3  # distinct seeds that a pattern must surround before it says anything
CONFIDENT = 0.8


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _accepted(kind: str, match: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x[-3:] if len(x) > 3 else x) <= 255 for x in match.split("."))
    count = sum("0" <= c <= "9" for c in match)
    if kind == "phone":
        return 9 <= count <= 15
    return 13 <= count <= 19 and _luhn(re.sub("[^0-9]", "", match))


def _matches(kind: str, text: str) -> Iterator[re.Match]:
    """Leftmost matches that do not overlap, in time that grows with the text."""
    if kind != "email":
        yield from _COMPILED[kind].finditer(text)
        return
    at = 0
    while run := _MAILBOX.search(text, at):
        # Only a run that an at sign follows is tried, and once: what follows decides.
        match = _COMPILED[kind].match(text, run.start()) if text.startswith("@", run.end()) else None
        if match:
            yield match
        at = match.end() if match else run.end()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` in code points, by kind as listed and then by start."""
    out = []
    if _DIGIT.search(text) or "@" in text:
        for kind in PATTERNS:
            if _NEEDED.get(kind, "") in text:
                out += [(kind, m.start(), m.end()) for m in _matches(kind, text) if _accepted(kind, m.group())]
    return out


def _patterns(text: str, start: int) -> list[str]:
    """The last word and the last two words before ``start``."""
    width, before = 128, []
    while True:
        before = text[max(0, start - width) : start].split()
        # The first word of a window may be cut.
        if width >= start or len(before) > 2:
            break
        width *= 4
    before = [w.lower() for w in before[-2:]]
    return [" ".join(before[-n:]) for n in (1, 2) if len(before) >= n]


def tokens_in_context(text: str, spans: list[tuple[str, int, int]]) -> list[tuple]:
    """``start, end, instance, patterns, kind`` of base matches and of candidates.

    Base matches come whole, without those inside another one. Candidates are runs of
    neighbouring tokens like identifiers that no base match touches, up to the end of a
    clause; their kind is None. The patterns are the last word and the last two words before.
    """
    seeds: list[tuple[str, int, int]] = []
    for s in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not seeds or s[2] > seeds[-1][2]:
            seeds.append(s)
    starts = [a for _, a, _ in seeds]
    runs: list[tuple[int, int]] = []
    closed = True
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        last = bisect_left(starts, end) - 1
        if last >= 0 and seeds[last][2] > start:
            closed = True
            continue
        if not closed and text[runs[-1][1] : start].isspace():
            runs[-1] = (runs[-1][0], end)
        else:
            runs.append((start, end))
        closed = text[end - 1] in _CLAUSE
    found = [(a, b, kind) for kind, a, b in seeds]
    for start, end in runs:
        kept = len(text[start:end].rstrip(_TRAILING))
        if kept >= MIN_TOKEN:
            found.append((start, start + kept, None))
    return [
        (start, end, " ".join(text[start:end].lower().split()), _patterns(text, start), kind)
        for start, end, kind in sorted(found, key=lambda x: x[:2])
    ]


def _text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text_key, spans, tokens`` of every row; the key, a SHA-256, stands for the text."""
    token = "struct<start:int,end:int,instance:string,patterns:array<string>,kind:string>"
    span = "struct<kind:string,start:int,end:int>"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        token_type = pa.list_(
            pa.struct(
                [("start", pa.int32()), ("end", pa.int32()), ("instance", pa.string()),
                 ("patterns", pa.list_(pa.string())), ("kind", pa.string())]
            )
        )
        for batch in slices(batches):
            spans, tokens = [], []
            for value in batch.column("text"):
                text = value.as_py()
                own = base_spans(text)
                near = tokens_in_context(text, own)
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in own])
                tokens.append([dict(zip(("start", "end", "instance", "patterns", "kind"), t, strict=True)) for t in near])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(spans, span_type), pa.array(tokens, token_type)],
                ["id", "text_key", "spans", "tokens"],
            )

    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), _text_key(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(look, f"id long, text_key binary, spans array<{span}>, tokens array<{token}>")


def confident_instances(scanned: DataFrame) -> DataFrame:
    """Instances that no base pattern matches but confident contexts surround."""
    tokens = scanned.select(F.explode("tokens").alias("t")).select("t.*")
    graph = stage(
        tokens.select("instance", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.count(F.lit(1)).alias("n"), F.max("kind").isNotNull().alias("seed")),
        "contexts",
    )
    # A pattern with fewer instances never surrounds enough seeds, whatever they turn out to be.
    able = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= MIN_SEEDS)
    edges = stage(graph.join(able.select("pattern"), "pattern"), "contexts")
    # Base matches are worth 1 throughout; other instances are listed once a pattern speaks for them.
    seeds = edges.where("seed").select("instance").distinct()
    worth = stage(seeds.select("instance", F.lit(1.0).alias("worth"), F.lit(True).alias("seed")), "instances")
    for _ in range(ROUNDS):
        weighed = edges.drop("seed").join(worth, "instance", "left")
        trusted = F.count_if(F.col("seed") | (F.col("worth") >= CONFIDENT))
        said = F.sum(F.col("n") * F.coalesce("worth", F.lit(0.0))) / (F.sum("n") + 1)
        patterns = weighed.groupBy("pattern").agg(trusted.alias("trusted"), said.alias("score"))
        patterns = patterns.where(F.col("trusted") >= MIN_SEEDS).select("pattern", "score")
        doubt = F.exp(F.sum(F.log1p(-F.least("score", F.lit(0.999)))))
        spoken = edges.drop("seed").join(patterns, "pattern").groupBy("instance").agg((1 - doubt).alias("worth"))
        others = spoken.join(seeds, "instance", "left_anti").withColumn("seed", F.lit(False))
        own = seeds.select("instance", F.lit(1.0).alias("worth"), F.lit(True).alias("seed"))
        worth = stage(own.union(others), "instances")
    return worth.where(~F.col("seed") & (F.col("worth") >= CONFIDENT)).select("instance")


def found_by_context(scanned: DataFrame) -> DataFrame:
    """``text_key, more``: the spans that confident instances add, once per distinct text."""
    tokens = scanned.select("text_key", F.explode("tokens").alias("t")).where(F.col("t.kind").isNull())
    found = tokens.join(
        confident_instances(scanned), F.col("t.instance") == F.col("instance"), "left_semi"
    )
    own = F.struct(F.lit("context").alias("kind"), F.col("t.start").alias("start"), F.col("t.end").alias("end"))
    # Combined before the shuffle; a text has at most one entry per token.
    return found.select("text_key", own.alias("span")).distinct().groupBy("text_key").agg(
        F.sort_array(F.collect_list("span")).alias("more")
    )


def personal_data(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text_key, base, more``: arrays of spans ``kind, start, end`` for every row."""
    scanned = stage(scan(docs, id_col, text_col), "pii")
    more = stage(found_by_context(scanned), "pii-more")
    joined = scanned.join(more, "text_key", "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return joined.select("id", "text_key", F.col("spans").alias("base"), F.coalesce("more", none).alias("more"))


def mask(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with each span in ``text_col`` replaced by its kind in angle brackets."""
    scanned = stage(scan(docs, id_col, text_col), "pii")
    more = stage(found_by_context(scanned), "pii-more")
    text = F.coalesce(text_col, F.lit(""))
    names = docs.columns
    # Longer than any column of ``docs``, so neither name clashes.
    key, extra = (n + "_" * max(map(len, names)) for n in ("key", "more"))
    keyed = docs.withColumn(key, _text_key(text))
    joined = keyed.join(more.withColumnsRenamed({"text_key": key, "more": extra}), key, "left").drop(key)
    place = names.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, more in zip(batch.column(text_col), batch.column(extra).to_pylist(), strict=True):
                value = text.as_py()
                if value is not None:
                    added = [(s["kind"], s["start"], s["end"]) for s in more or ()]
                    value = masked(value, base_spans(value) + added)
                out.append(value)
            columns = [batch.column(c) for c in names]
            columns[place] = pa.array(out, batch.column(text_col).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(replace, docs.schema)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with spans replaced; overlapping ones are replaced together."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += (text[at:start], f"<{kind.upper()}>")
        at = max(at, end)
    return "".join([*out, text[at:]])


def span_text(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
