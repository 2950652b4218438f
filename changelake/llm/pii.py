"""Personal data and the terms that give it away, with SQL functions only.

Base spans: email, ip, card and phone by pattern, leftmost and non-overlapping
per kind, in code points; matches that fail their check are dropped.

Information-theoretic sanitisation adds spans. A protected entity c is one
normalised base value, its contexts are the lines it stands in. Over all lines
of the corpus, with N lines, n_c of them with c, n_t with term t and n_ct with
both: IC(c) = ln(N / n_c) and PMI(c; t) = ln(n_ct N / (n_c n_t)). A term
discloses c if PMI >= ``alpha`` IC(c), that is, if seeing the term gives away
almost all the information of c, and the pair was seen in at least ``support``
different line texts (copies of a line count once). Such a term, next to c, is
generalised to its first letters if that form no longer discloses c, or else
removed.

The patterns equal the contract's; possessive repeats and the look-behind at
the start of a run keep Java's matcher linear on long runs (``\\G`` lets a
match start where the last one ended).

Defined results: a null text counts as empty and has no spans; empty tables
give no rows. Rows are told apart by their place in the table, so repeated rows
and null ids are treated one by one. Sanitised text keeps null as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash, fresh, with_row

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Kinds in their order, with patterns.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of these has no span of the kind.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
         "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
TERM = r"[\p{L}\p{N}]{3,}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total, i):
        d = F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


_VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda v: F.length(_digits(v)).between(12, 19) & _luhn(_digits(v)),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}

_SPAN = "array<struct<start:int,no:int,end:int,kind:string,value:string>>"


def matches(text: Column, pattern: Column, no: int, kind: str, valid) -> Column:
    """Spans of all matches of ``pattern``: the parts between them add up to
    their places."""
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.split(text, pattern, -1)
    pairs = F.slice(F.arrays_zip(parts.alias("part"), hits.alias("hit")), 1, F.size(hits))

    def step(acc, x):
        start = acc["at"] + F.char_length(x["part"])
        end = start + F.char_length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(no).alias("no"), end.alias("end"),
                        F.lit(kind).alias("kind"), x["hit"].alias("value"))
        return F.struct(end.alias("at"), F.when(valid(x["hit"]), F.array_append(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))
    return F.aggregate(pairs, start, step, lambda acc: acc["spans"])


def base_spans(text: Column) -> Column:
    """All base spans, by start and then kind."""
    none = F.array().cast(_SPAN)
    found = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        hint = text.contains("@") if kind == "email" else text.rlike(_HINT[kind])
        found.append(F.when(hint, matches(text, F.lit(pattern), no, kind, _VALID[kind])).otherwise(none))
    return F.array_sort(F.concat(*found))


def _entity(span: Column) -> Column:
    """Numbers by their digits, the rest in lower case."""
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def _generalised(term: Column) -> Column:
    return F.concat(F.left(term, F.lit(3)), F.lit("*"))


def _spans_of(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(_row, doc_id, spans, lines): lines are those that hold a base span."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = with_row(docs.select(F.col(id_col).alias("doc_id"), t.alias("text")))
    base = base.withColumn("spans", base_spans(F.col("text")))

    def line_of(s):
        before = F.instr(F.reverse(F.left(F.col("text"), s["start"])), F.lit("\n"))
        after = F.instr(F.substr(F.col("text"), s["end"] + 1), F.lit("\n"))
        return F.struct(
            F.when(before > 0, s["start"] - before + 1).otherwise(0).cast("int").alias("at"),
            F.when(after > 0, s["end"] + after - 1).otherwise(F.char_length("text")).cast("int").alias("to"))

    lines = F.transform(F.array_distinct(F.transform("spans", line_of)), lambda x: F.struct(
        x["at"].alias("at"), F.substr(F.col("text"), x["at"] + 1, x["to"] - x["at"]).alias("line")))
    return base.select("_row", "doc_id", "spans",
                       F.when(F.size("spans") > 0, lines).alias("lines"))


def _terms(line: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0)))


def disclosing(docs: DataFrame, entity_lines: DataFrame, alpha: float, support: int,
               text: str = "text") -> DataFrame:
    """(entity, term, form): terms that give an entity away; ``form`` is what
    stands for the term, empty if even the general form discloses.

    ``entity_lines(entity, _row, at, line)``. Counts run over every line of
    ``docs``, combined before the shuffle.
    """
    stash = Stash(docs.sparkSession, "pii")
    pair = entity_lines.select("entity", "_row", "at", F.xxhash64("line").alias("text"),
                               F.explode(_terms(F.col("line"))).alias("term"))
    by_term = pair.groupBy("entity", "term").agg(
        F.count("*").alias("n_ct"), F.count_distinct("text").alias("texts"))
    by_term = by_term.where(F.col("texts") >= support).withColumn("form", _generalised(F.col("term")))
    by_form = (pair.select("entity", "_row", "at", _generalised(F.col("term")).alias("form")).distinct()
               .groupBy("entity", "form").agg(F.count("*").alias("n_cf")))
    n_c = entity_lines.groupBy("entity").agg(F.count("*").alias("n_c"))

    line = docs.select(F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("line"))
    counts = stash.put(line.select(F.explode(_terms(F.col("line"))).alias("term"))
                       .groupBy("term").agg(F.count("*").alias("n_t")))
    forms = counts.groupBy(_generalised(F.col("term")).alias("form")).agg(F.sum("n_t").alias("n_f"))
    breaks = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    n = F.lit(float(docs.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0))

    found = by_term.join(n_c, "entity").join(counts, "term")
    ic = F.log(n / F.col("n_c"))
    pmi = F.log(F.col("n_ct") * n / (F.col("n_c") * F.col("n_t")))
    found = found.where((ic > 0) & (pmi >= alpha * ic))
    found = found.join(by_form, ["entity", "form"]).join(forms, "form")
    pmi_form = F.log(F.col("n_cf") * n / (F.col("n_c") * F.col("n_f")))
    return found.select("entity", "term",
                        F.when(pmi_form < alpha * ic, F.col("form")).otherwise("").alias("form"))


def find(docs: DataFrame, alpha: float = 0.9, support: int = 3, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(_row, doc_id, base, added): the base spans and the added term spans of
    every row; ``value`` of an added span is what the term becomes."""
    stash = Stash(docs.sparkSession, "pii-spans")
    spans = stash.put(_spans_of(docs, id_col, text))
    held = spans.where(F.size("spans") > 0)
    each = held.select("_row", F.explode("lines").alias("l"), "spans").select(
        "_row", F.col("l.at").alias("at"), F.col("l.line").alias("line"),
        F.explode(F.array_distinct(F.transform(F.filter("spans", lambda s: (s["start"] >= F.col("l.at")) & (
            s["end"] <= F.col("l.at") + F.char_length("l.line"))), _entity))).alias("entity"))
    each = stash.put(each)
    reveal = stash.put(disclosing(docs, each, alpha, support, text))
    hit = (each.join(reveal, "entity").where(F.instr(F.lower("line"), F.col("term")) > 0)
           .groupBy("_row", "at", "line", "term").agg(F.min("form").alias("form")))
    whole = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])"), F.col("term"), F.lit(r"(?![\p{L}\p{N}])"))
    place = matches(F.col("line"), whole, len(PATTERNS), "term", lambda v: F.lit(True))
    added = (hit.select("_row", "at", "form", F.explode(place).alias("s"))
             .select("_row", F.struct((F.col("s.start") + F.col("at")).alias("start"), "s.no",
                                      (F.col("s.end") + F.col("at")).alias("end"), "s.kind",
                                      F.col("form").alias("value")).alias("s"))
             .groupBy("_row").agg(F.array_sort(F.collect_set("s")).alias("terms")))
    clear = lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    joined = held.join(added, "_row", "left")
    none = F.array().cast(_SPAN)
    joined = joined.select("_row", "doc_id", F.col("spans").alias("base"), F.coalesce(
        F.filter(F.col("terms"), clear), none).alias("added"))
    return joined.unionByName(spans.where(F.size("spans") == 0).select(
        "_row", "doc_id", F.col("spans").alias("base"), none.alias("added")))


def joined_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitise(docs: DataFrame, alpha: float = 0.9, support: int = 3, text: str = "text") -> DataFrame:
    """``docs`` with every base span replaced by its kind in brackets and every
    added span by its general form or nothing; other columns as they were."""
    found = find(docs, alpha, support, text=text).where(F.size("base") > 0)
    row, spans = fresh(docs, "_row"), fresh(docs, "_spans")
    found = Stash(docs.sparkSession, "pii-found").put(found.select(
        F.col("_row").alias(row), F.array_sort(F.concat("base", "added")).alias(spans)))
    rows = with_row(docs, row)

    def step(acc, s):
        mark = F.when(s["kind"] == "term", s["value"]).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        gap = F.substr(F.col(text), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        # A span that begins inside the last one only moves the end.
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(
            s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap, mark))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    new = F.aggregate(spans, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substr(F.col(text), acc["at"] + 1)))
    changed = rows.join(found, row).withColumn(text, new).select(*docs.columns)
    # Which rows changed is decided by the same expression as above, row by row.
    same = rows.where(F.coalesce(F.size(base_spans(F.col(text))), F.lit(0)) <= 0).select(*docs.columns)
    return same.unionByName(changed)
