"""Personal data and the terms around it that give it away, by how much a term tells about a protected entity.

Base kinds are found by pattern: e-mail, IP, card and phone. Each found value is a protected entity e. For
a term t in its context, the corpus tells how much t discloses: of the information IC(e) = -log2 p(e) that
an observer lacks, PMI(e; t) = log2(p(e | t) / p(e)) is told, and IC - PMI = -log2 p(e | t) bits are left,
whatever the size of the corpus. A term that leaves few bits is sanitised where it stands in the entity's
context: generalised, or removed where it as good as names the entity.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import fresh, written

#: Kinds in order. Patterns are those of the base rules, made linear: a match can only begin
#: where its first run of characters does (or where the last match ended), and no run is given back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
_IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

#: Characters of context on either side of an entity (up to the next of its kind), and shortest term.
CONTEXT = 80
TERM = r"\p{L}{3,}"
#: A term is sanitised where it leaves at most so many bits about the entity (3: it is one of 8 texts), and removed
#: where it leaves at most the second number; it has to tell TOLD bits, as in a small corpus every term leaves few.
#: Near an entity of several texts it counts if it is there in LEAST_TEXTS of them. As little is known of what is
#: seen once, a term near an entity of one text has to tell TOLD_ALONE bits (be 256 times as likely there as
#: elsewhere), and counts as if it stood in PRIOR more documents.
GENERALISE, REMOVE = 3.0, 1.0
TOLD, TOLD_ALONE = 2.0, 8.0
LEAST_TEXTS = 2
PRIOR = 1
#: Matches of a pattern take two characters at least, so no more than this many begin within a context.
_NEAR = CONTEXT // 2

_SPAN = "array<struct<start:int,kind_no:int,end:int,value:string,before:string,after:string>>"


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def prefix_sums(steps: Column) -> Column:
    """For each place the sum of the steps before it. Two levels: a long array costs its length times 256."""
    block = 256
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    blocks = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(steps)), lambda i: i % block == 0), lambda i: total(F.slice(steps, i + 1, F.lit(block)))
    )
    bases = lambda sums: F.transform(sums, lambda _, c: total(F.slice(sums, F.lit(1), c)))

    def place(base: Column) -> Column:
        def at(_: Column, i: Column) -> Column:
            return F.get(base, F.floor(i / block).cast("int")) + total(F.slice(steps, i - i % block + 1, i % block))

        return F.transform(steps, at)

    return _once(_once(blocks, bases), place)


def _matches(text: Column, pattern: str) -> Column:
    """Matches with their places: start, value, before and after (the text to the neighbouring matches)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(m: Column) -> Column:
        def with_gaps(g: Column) -> Column:
            steps = F.transform(m, lambda x, i: F.length(F.get(g, i)) + F.length(x))

            def with_sums(s: Column) -> Column:
                return F.transform(
                    m,
                    lambda x, i: F.struct(
                        (F.get(s, i) + F.length(F.get(g, i))).alias("start"), x.alias("value"), F.get(g, i).alias("before"), F.get(g, i + 1).alias("after")
                    ),
                )

            return _once(_once(steps, prefix_sums), with_sums)

        return _once(gaps, with_gaps)

    return _once(found, placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _luhn(value: Column) -> Column:
    def weigh(i: Column, digits: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return F.when(twice & (digit > 4), digit * 2 - 9).when(twice, digit * 2).otherwise(digit)

    def passes(digits: Column) -> Column:
        total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: weigh(i, digits)), F.lit(0), lambda a, x: a + x)
        return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(F.lit(False))

    return _once(_digits(value), passes)


#: Which matches count, and a cheap test that a text without any of them fails.
_VALID = {
    "email": lambda value: F.lit(True),
    "ip": lambda value: value.rlike(_IP_PARTS),
    "card": _luhn,
    "phone": lambda value: F.length(_digits(value)).between(9, 15),
}
_HINT = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
}


def base_spans(text: Column) -> Column:
    """All base spans of a text by start, then kind, with their context."""

    def of(kind: str) -> Column:
        def judged(x: Column) -> Column:
            """A match with whether it counts, and with what a neighbour's context may need of it."""
            ends = [f(x[c], F.lit(CONTEXT)).alias(n) for f, c, n in ((F.right, "before", "before"), (F.left, "after", "after"), (F.right, "value", "tail"), (F.left, "value", "head"))]
            return F.struct(x["start"].alias("start"), x["value"].alias("value"), _VALID[kind](x["value"]).alias("valid"), *ends)

        def spans(found: Column) -> Column:
            at = F.filter(F.sequence(F.lit(0), F.size(found)), lambda i: F.get(found, i)["valid"])
            return F.transform(at, lambda i: _once(F.get(found, i), lambda x: span(found, i, x)))

        def span(found: Column, i: Column, x: Column) -> Column:
            first = F.greatest(i - _NEAR, F.lit(0))
            before = F.aggregate(
                F.slice(found, first + 1, i - first), F.lit(""), lambda far, m: F.when(m["valid"], F.lit("")).otherwise(F.right(F.concat(far, m["before"], m["tail"]), F.lit(CONTEXT)))
            )
            zero = F.struct(x["after"].alias("text"), F.lit(False).alias("ended"))

            def longer(so_far: Column, m: Column) -> Column:
                ended = so_far["ended"] | m["valid"]
                text = F.when(ended, so_far["text"]).otherwise(F.left(F.concat(so_far["text"], m["head"], m["after"]), F.lit(CONTEXT)))
                return F.struct(text.alias("text"), ended.alias("ended"))

            after = F.aggregate(F.slice(found, i + 2, F.lit(_NEAR)), zero, longer, lambda so_far: so_far["text"])
            return F.struct(
                x["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("kind_no"),
                (x["start"] + F.length(x["value"])).alias("end"),
                x["value"].alias("value"),
                F.right(F.concat(before, x["before"]), F.lit(CONTEXT)).alias("before"),
                after.alias("after"),
            )

        return F.when(_HINT[kind](text), _once(F.transform(_matches(text, PATTERNS[kind]), judged), spans)).otherwise(F.array().cast(_SPAN))

    return F.sort_array(F.concat(*[of(kind) for kind in PATTERNS]))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind_no"]), x["start"], x["end"])), ",")


def _terms(context: Column, start: Column) -> Column:
    """Terms of a context that starts at this place of the text."""
    return F.transform(
        _matches(context, TERM),
        lambda x: F.struct(F.lower(x["value"]).alias("term"), (start + x["start"]).alias("start"), (start + x["start"] + F.length(x["value"])).alias("end")),
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("h", F.xxhash64("text"))


def contexts(found: DataFrame) -> DataFrame:
    """A row per term near an entity: row, doc_id, h, entity, term, start, end. found has doc_id, h and spans."""
    rows = found.where(F.size("spans") > 0).select(F.monotonically_increasing_id().alias("row"), "doc_id", "h", "spans")
    rows = rows.select("row", "doc_id", "h", F.inline("spans"))
    name = F.when(F.col("kind_no") == 0, F.lower("value")).otherwise(F.regexp_replace("value", r"[^0-9.+]", ""))
    # A word that the window cuts is no term: one at the far end of a full window goes.
    far = F.when(F.length("before") == CONTEXT, F.regexp_replace("before", r"^\p{L}+", "")).otherwise(F.col("before"))
    near = F.when(F.length("after") == CONTEXT, F.regexp_replace("after", r"\p{L}+$", "")).otherwise(F.col("after"))
    around = F.concat(_terms(far, F.col("start") - F.length(far)), _terms(near, F.col("end")))
    entity = F.concat_ws(":", F.col("kind_no"), name)
    return rows.select("row", "doc_id", "h", entity.alias("entity"), F.inline(around))


def disclosing(around: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (entity, term, left) with the bits left about the entity, at most GENERALISE.

    docs (text) is the whole corpus: term, entity and both are counted over all its rows, on the map side first.
    """
    total = docs.count()
    once = around.select("entity", "term", "row", "h").distinct()
    pairs = once.groupBy("entity", "term").agg(F.count("*").alias("both"), F.count_distinct("h").alias("texts"))
    entities = around.select("entity", "row", "h").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"), F.count_distinct("h").alias("of_texts"))
    pairs = pairs.join(entities, "entity")
    pairs = written(pairs.where((F.col("texts") >= LEAST_TEXTS) | (F.col("of_texts") == 1)), "term-pairs")
    letters = F.array_distinct(F.split(F.lower("text"), r"\P{L}+"))
    terms = docs.select(F.explode(letters).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    alone = F.col("of_texts") == 1
    prior = F.when(alone, PRIOR).otherwise(0)
    left = F.log2((F.col("n_term") + prior) / F.col("both"))
    told = F.log2(F.lit(float(max(total, 1))) / F.col("n_entity")) - F.col("left")
    counted = pairs.join(terms, "term").withColumn("left", left)
    return counted.where((F.col("left") <= GENERALISE) & (told >= F.when(alone, TOLD_ALONE).otherwise(TOLD))).select("entity", "term", "left")


def term_spans(found: DataFrame, docs: DataFrame) -> DataFrame:
    """For each document with disclosing terms: doc_id, h, terms (start, kind_no, end, remove), by start."""
    around = written(contexts(found), "contexts")
    marked = around.join(disclosing(around, docs), ["entity", "term"])
    spans = marked.groupBy("doc_id", "h", "start", "end").agg((F.min("left") <= REMOVE).alias("remove"))
    span = F.struct("start", F.lit(KINDS.index("term")).alias("kind_no"), "end", "remove")
    return written(spans.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(span)).alias("terms")), "term-spans")


def _with_terms(found: DataFrame, terms: DataFrame) -> DataFrame:
    """found with its terms, without those within a base span."""
    right = terms.withColumnsRenamed({"doc_id": "_doc_id", "h": "_h"})
    joined = found.join(right, found["doc_id"].eqNullSafe(right["_doc_id"]) & (found["h"] == right["_h"]), "left").drop("_doc_id", "_h")
    free = F.filter("terms", lambda t: ~F.exists("spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return joined.withColumn("terms", F.coalesce(free, F.array().cast("array<struct<start:int,kind_no:int,end:int,remove:boolean>>")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    A null text is empty. Rows equal in id and text get equal results; rows of one id with different
    texts are told apart. Places are in code points, ends exclusive. Other columns are not read.
    """
    keyed = _keyed(docs, id_col, text_col)
    found = written(keyed.select("doc_id", "h", base_spans(F.col("text")).alias("spans")), "base-spans")
    both = _with_terms(found, term_spans(found, keyed))
    place = lambda x: F.struct(x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end"))
    every = F.sort_array(F.concat(F.transform("spans", place), F.transform("terms", place)))
    counts = [F.size(F.filter("spans", _is_kind(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(PATTERNS)]
    return both.select(
        "doc_id",
        *counts,
        F.sha2(listed(F.col("spans")), 256).alias("base_sha256"),
        listed(every).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def _is_kind(number: int) -> Callable[[Column], Column]:
    return lambda x: x["kind_no"] == number


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with personal data replaced by its kind in brackets, and disclosing terms generalised to
    [TERM] or removed; all their columns, n_chars (if any) kept true. Null texts stay null.

    Only documents with personal data are joined and rewritten; the others pass through.
    """
    spans, h, near, near_id, near_h = (fresh(docs, n) for n in ("_spans", "_h", "_terms", "_term_id", "_term_h"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.withColumn(spans, base_spans(text))
    keyed = _keyed(docs, id_col, text_col)
    found = written(keyed.select("doc_id", "h", base_spans(F.col("text")).alias("spans")).where(F.size("spans") > 0), "base-spans")
    terms = term_spans(found, keyed).withColumnsRenamed({"doc_id": near_id, "h": near_h, "terms": near})
    touched = marked.where(F.size(spans) > 0).withColumn(h, F.xxhash64(text))
    touched = touched.join(terms, touched[id_col].eqNullSafe(terms[near_id]) & (touched[h] == terms[near_h]), "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    edit = lambda x, by: F.struct(x["start"].alias("start"), x["end"].alias("end"), by.alias("by"))
    base = F.transform(spans, lambda x: edit(x, F.get(names, x["kind_no"])))
    extra = F.transform(F.coalesce(near, F.array().cast("array<struct<start:int,kind_no:int,end:int,remove:boolean>>")), lambda x: edit(x, F.when(x["remove"], F.lit("")).otherwise(F.get(names, x["kind_no"]))))
    edits = F.sort_array(F.concat(base, extra))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, x: Column) -> Column:
        # An edit that begins within the last one only widens what is gone.
        parts = F.when(x["start"] >= done["at"], F.concat(done["parts"], F.array(F.substr(text, done["at"] + 1, x["start"] - done["at"]), x["by"]))).otherwise(done["parts"])
        return F.struct(F.greatest(x["end"], done["at"]).alias("at"), parts.alias("parts"))

    clean = F.aggregate(edits, zero, step, lambda done: F.concat(F.array_join(done["parts"], ""), F.substr(text, done["at"] + 1)))
    rewritten = touched.withColumn(text_col, clean)
    if "n_chars" in docs.columns and text_col == "text":
        rewritten = rewritten.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return marked.where(F.size(spans) == 0).select(*docs.columns).union(rewritten.select(*docs.columns))
