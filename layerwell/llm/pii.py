"""Personal data: patterned identifiers, and words that give them away.

Patterns find e-mail and IP addresses, card and phone numbers in every text. These are
the protected entities. A word of a document that holds an entity reveals it if the corpus ties the
two together: with document counts n(c), n(t), n(c, t) of the entity, the word, and both, the
pointwise mutual information log2(N n(c, t) / (n(c) n(t))) is the information that the word gives
about the entity, out of log2(N / n(c)) that identifies it fully. The estimate is shrunk, so that few
counts must tell more: by ``FEW`` / n(c, t)^2 bits, and by counting a word of fewer than
``LONG`` characters in ``PRIOR`` further documents for each missing one. A word that
gives at least ``GENERALISE`` of the full information is generalised, one that gives at least ``REMOVE`` is
removed, in all documents that hold the entity, wherever it stands.

Words are runs of letters, digits and marks outside the identifiers. Entities held by the same
documents count as one group, so a document of many identifiers is not multiplied by them. Words too
frequent to reveal even the most frequent entity are left out before pairs are counted.

All work is done by SQL functions. Patterns are written so that a run of characters is
entered once: matching takes linear time on any text.

Defined results: null text counts as empty and has no spans; texts of any length are read
whole; overlapping spans of different kinds are all reported; in ``sanitise`` the
earlier span wins; repeated rows get the same result; an empty table gives an empty result;
further columns are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwell.llm.common import filter_bits, filter_words, packed, with_filter_hit
from layerwell.session import materialize

KINDS = ("email", "ip", "card", "phone")
ADDED = ("term", "gone")
FEW = 3.0  # bits taken off after a single common document
LONG, PRIOR = 4, 3
GENERALISE, REMOVE = 0.7, 0.95
_WORD = r"\p{L}\p{M}\p{N}"
WORD = rf"[\p{{L}}\p{{N}}][{_WORD}]*"

# Same matches as the plain patterns: what follows a possessive part never starts with a character of it,
# and a match inside a run could have started at the run's first character or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# A text without these has no match.
_NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]", "phone": "[+][0-9]"}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    length = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, length - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), length - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.regexp_like(value, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    size = F.length(_digits(value))
    if kind == "phone":
        return size.between(9, 15)
    return F.when(size.between(12, 19), luhn(_digits(value))).otherwise(F.lit(False))


def _matches(text: Column, pattern: Column | str) -> Column:
    """All matches with code-point positions: array of (start, end, value); the text between matches gives the positions."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    # Zipped outside the lambda: what a lambda names is evaluated again for each of its elements.
    zipped = F.arrays_zip(found.alias("value"), F.slice(between, F.lit(1), F.size(found)).alias("gap"))
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def place(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    state = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    return F.aggregate(zipped, state, place, lambda s: s["out"])


def _kind_spans(text: Column, rank: int, kind: str) -> Column:
    """Valid spans of one kind: array of (start, kind, end, value)."""

    def named(m: Column) -> Column:
        return F.struct(m["start"].alias("start"), F.lit(rank).alias("kind"), m["end"].alias("end"), m["value"].alias("value"))

    spans = F.transform(F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"])), named)
    return F.when(F.regexp_like(text, F.lit(_NEEDS[kind])), spans).otherwise(_no_spans())


def _base(text: Column) -> Column:
    """Valid spans of all kinds, by start and kind."""
    return F.array_sort(F.concat(*(_kind_spans(text, rank, kind) for rank, kind in enumerate(KINDS))))


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")


def _found(docs: DataFrame, id_col: str, text_col: str, label: str) -> DataFrame:
    """(doc_id, key, base): key names a document by id and text, the same on every read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), _key(id_col, text_col).alias("key"), _base(text).alias("base"))
    return materialize(rows, label)


def _key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _entity(span: Column) -> Column:
    """An entity's name: its kind and its value without spelling differences."""
    value = F.when(span["kind"] == 0, F.lower(span["value"])).when(span["kind"] == 1, span["value"]).otherwise(_digits(span["value"]))
    return F.concat(span["kind"].cast("string"), F.lit(":"), value)


def _outside(text: Column) -> Column:
    """The text with a space for every valid identifier."""
    for kind in KINDS:
        pattern = F.lit(PATTERNS[kind])
        found, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
        zipped = F.arrays_zip(between.alias("gap"), found.alias("value"))
        left = lambda x: F.when(_valid(kind, x["value"]), F.lit(" ")).otherwise(F.coalesce(x["value"], F.lit("")))  # noqa: B023, E731
        masked = F.array_join(F.transform(zipped, lambda x: F.concat(x["gap"], left(x))), "")  # noqa: B023
        text = F.when(F.regexp_like(text, F.lit(_NEEDS[kind])), masked).otherwise(text)
    return text


def _words(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def _tied(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Telling words (group, term, share), where they may stand (key, group, term), and the entities (entity, group, n_c)."""
    held = found.where(F.size("base") > 0).select("key", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
    held = materialize(held.distinct(), "held")
    entities = held.groupBy("entity").agg(F.count("*").alias("n_c"), F.bit_xor(F.xxhash64("key")).alias("keys"))
    entities = materialize(entities.select("entity", F.xxhash64("n_c", "keys").alias("group"), "n_c"), "entities")
    member = held.join(entities, "entity").groupBy("key").agg(F.collect_set("group").alias("groups"))
    member = materialize(member, "member")

    bits = filter_bits(member.count())
    touched = materialize(filter_words(member, F.col("key"), bits), "holders")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(_key(id_col, text_col).alias("key"), _words(_outside(text)).alias("words"))
    holders = with_filter_hit(rows, F.col("key"), touched, bits, "hit").where("hit").drop("hit").join(member, "key")
    holders = materialize(holders.dropDuplicates(["key"]), "holders")

    terms = materialize(holders.select(F.explode("words").alias("term")).distinct(), "terms")
    bits = filter_bits(terms.count())
    asked = materialize(filter_words(terms, F.col("term"), bits), "asked")
    spoken = with_filter_hit(rows.select(F.explode("words").alias("term")), F.col("term"), asked, bits, "hit").where("hit")
    n = float(found.count())
    most = entities.agg(F.max("n_c")).first()[0] or 1
    # n(c, t) is at most n(c), so no other word can give enough of any entity.
    counts = spoken.groupBy("term").agg(F.count("*").alias("n_t")).where(F.col("n_t") <= 1.001 * n ** (1 - GENERALISE) * most**GENERALISE)
    counts = materialize(counts, "counts")
    bits = filter_bits(counts.count())
    rare = materialize(filter_words(counts, F.col("term"), bits), "rare")
    near = holders.select("key", "groups", F.explode("words").alias("term"))
    near = with_filter_hit(near, F.col("term"), rare, bits, "hit").where("hit")
    near = materialize(near.select("key", F.explode("groups").alias("group"), "term"), "near")

    pairs = near.groupBy("group", "term").agg(F.count("*").alias("n_ct"))
    pairs = pairs.join(entities.select("group", "n_c").distinct(), "group").join(counts, "term")
    spread = F.col("n_t") + PRIOR * F.greatest(F.lit(0), LONG - F.length("term"))
    shared = F.log2(F.lit(n) * F.col("n_ct") / (F.col("n_c").cast("double") * spread)) - FEW / (F.col("n_ct") * F.col("n_ct"))
    full = F.log2(F.lit(n) / F.col("n_c"))
    telling = pairs.where((full > 0) & (shared >= GENERALISE * full)).select("group", "term", (shared / full).alias("share"))
    return materialize(telling, "telling"), near, entities


def revealing_terms(docs: DataFrame, found: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Which words reveal which entities (entity, term, share), and the groups' words (key, group, term)."""
    telling, near, entities = _tied(docs, found, id_col, text_col)
    return telling.join(entities, "group").select("entity", "term", "share"), near


def _added(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, added): spans of revealing words in the documents that hold what they reveal."""
    telling, near, _ = _tied(docs, found, id_col, text_col)
    per_doc = near.join(telling, ["group", "term"]).groupBy("key", "term").agg(F.max("share").alias("share"))
    rank = F.when(F.col("share") >= REMOVE, len(KINDS) + 1).otherwise(len(KINDS))
    per_doc = per_doc.groupBy("key").agg(F.collect_list(F.struct("term", rank.alias("kind"))).alias("terms"))
    per_doc = materialize(per_doc, "terms")
    bits = filter_bits(per_doc.count())
    words = materialize(filter_words(per_doc, F.col("key"), bits), "touched")
    rows = docs.select(_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    rows = with_filter_hit(rows, F.col("key"), words, bits, "hit").where("hit").drop("hit").join(per_doc, "key").dropDuplicates(["key"])
    kinds = F.map_from_entries("terms")
    pattern = F.concat(F.lit(rf"(?iu)(?<![{_WORD}])(?:"), F.array_join(F.array_sort(F.map_keys(kinds)), "|"), F.lit(rf")(?![{_WORD}])"))
    spans = F.transform(
        _matches(F.col("text"), pattern),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.coalesce(F.element_at(kinds, F.lower(m["value"])), F.lit(len(KINDS))).alias("kind"),
            m["end"].alias("end"),
        ),
    )
    return rows.select("key", spans.alias("added"))


def _named(spans: Column) -> Column:
    names = F.array(*(F.lit(n) for n in KINDS + ADDED))
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(parts, ",")


def _short(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, key, base and spans, both arrays of (start, kind, end) in code points, end exclusive."""
    found = _found(docs, id_col, text_col, "base")
    added = materialize(_added(docs, found, id_col, text_col), "added")
    base = _short(F.col("base"))
    both = F.array_sort(F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    return found.join(added, "key", "left").select("doc_id", "key", base.alias("base"), both.alias("spans"))


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, counts per kind, digest of the base spans, all spans as text."""
    count = lambda r: F.size(F.filter("base", lambda s: s["kind"] == r)).cast("long")
    return find_spans(docs, id_col, text_col).select(
        "doc_id",
        *(count(r).alias(f"n_{kind}") for r, kind in enumerate(KINDS)),
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.col("spans")).alias("spans"),
    )


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with identifiers replaced by their kind, revealing words generalised to [TERM] or removed."""
    spans = find_spans(docs, id_col, text_col).where(F.size("spans") > 0).select("key", "spans").dropDuplicates(["key"])
    spans = materialize(spans, "spans")
    bits = filter_bits(spans.count())
    words = materialize(filter_words(spans, F.col("key"), bits), "touched")
    rows = docs.select(packed(docs), _key(id_col, text_col).alias("key"))
    rows = with_filter_hit(rows, F.col("key"), words, bits, "hit")
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS), F.lit("[TERM]"), F.lit(""))
    text = F.col(f"row.`{text_col}`")

    def replace(state: Column, span: Column) -> Column:
        piece = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        done = F.struct(span["end"].alias("at"), F.concat(state["out"], F.array(piece, F.element_at(marks, span["kind"] + 1))).alias("out"))
        return F.when(span["start"] >= state["at"], done).otherwise(state)

    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text) - s["at"]))
    clean = F.when(F.col("spans").isNotNull(), F.aggregate("spans", state, replace, rest)).otherwise(text)
    touched = rows.where("hit").join(spans, "key", "left").select(F.col("row").withField(f"`{text_col}`", clean).alias("row"))
    return rows.where("not hit").select("row.*").unionByName(touched.select("row.*"))
