"""Many saved filters over postings, and many searches of the registry, in one query each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.grams import GRAM, folded, grams, held_grams, py_grams, required_literals
from ..functions.jscompat import WORD_BOUNDARY, js_escape_literal, js_regex, py_js_trim, truthy_or, utf16_len, validate_java_regex
from .filters import DEFAULT, ORDER_COLS, as_of_ms, first_n_per, normalise_limit, recency_predicate

#: Parts into which the matches of one search term are dealt.
SALTS = 16


# ---------------------------------------------------------------- registry searches
def search_many(registry: DataFrame, queries: DataFrame) -> DataFrame:
    """The registry rows that each of many searches finds, with its ``query_id``.

    ``queries`` has (query_id, query, sector); each works as ``search_registry_tool`` does: the
    term is the query, else the sector, and is looked for, regardless of case, in the name (or
    slug) and in the sector; a sector must also be contained in the company's.  A search with
    neither finds nothing.  Repeated searches and repeated registry rows count each.

    A company that holds a term holds all of the term's n-grams (of three characters, or the
    whole of a shorter term).  Companies are therefore joined to searches on the term's rarest
    n-gram, and the candidates checked exactly.
    """
    name, sector = F.lower(truthy_or("name", "slug", F.lit(""))), F.lower(F.coalesce(F.col("sector"), F.lit("")))
    term = F.lower(truthy_or("query", "sector", F.lit("")))
    asked = queries.select("query_id", term.alias("_term"), F.lower(F.coalesce(F.col("sector"), F.lit(""))).alias("_in")).where("_term <> ''")
    own = F.when(F.length("_term") >= GRAM, grams(F.col("_term"), (GRAM,))).otherwise(F.array("_term"))
    wanted = asked.select("*", F.explode(own).alias("_gram"))
    rows = registry.select(F.struct(*registry.columns).alias("_row"), name.alias("_name"), sector.alias("_sector"))
    index = rows.select("*", F.explode(F.array_distinct(F.concat(grams(F.col("_name")), grams(F.col("_sector"))))).alias("_gram"))
    index = index.join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    often = index.groupBy("_gram").agg(F.count("*").alias("_n"))
    # a term with an n-gram that no company has finds nothing
    chosen = wanted.join(often, "_gram", "left").groupBy("query_id", "_term", "_in").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_least"))
    chosen = chosen.where("_least.n > 0").select("_term", "_in", F.col("_least._gram").alias("_gram"), "query_id")
    times = asked.groupBy("query_id", "_term", "_in").agg(F.count("*").alias("_times"))
    chosen = chosen.join(times, ["query_id", "_term", "_in"]).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = index.withColumn("_salt", F.pmod(F.xxhash64("_name", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")).join(chosen, ["_gram", "_salt"])
    has = lambda text, part: F.contains(F.col(text), F.col(part))
    found = found.where((has("_name", "_term") | has("_sector", "_term")) & has("_sector", "_in"))
    found = found.select("query_id", "_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_nth"))
    return found.select("query_id", "_row.*")


# ---------------------------------------------------------------- saved filters
_KEYWORD = T.StructType([T.StructField("word", T.BooleanType()), T.StructField("text", T.StringType())])
_FILTER = T.StructType([
    T.StructField("filter_id", T.StringType()), T.StructField("key", T.StringType()), T.StructField("own", T.ArrayType(T.StringType())),
    T.StructField("all", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("title", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("since", T.LongType()), T.StructField("dated", T.BooleanType()), T.StructField("includes", T.ArrayType(_KEYWORD)), T.StructField("excludes", T.ArrayType(_KEYWORD)),
])
#: What every posting is looked up by besides its n-grams: filters without a required text.
ANY = "*"
#: Plan size up to which the saved filters go to all tasks.
BROADCAST_BYTES = 8 << 20


def _keywords(words) -> list[tuple[bool, str]] | None:
    if not isinstance(words, (list, tuple)) or not words:
        return None
    lower = [py_js_trim(str("" if w is None else w).lower()) for w in words]
    return [(True, WORD_BOUNDARY + js_escape_literal(w) + WORD_BOUNDARY) if utf16_len(w) <= 4 else (False, w) for w in lower if w]


def _compiled(spark, filter_id: str, spec: dict, as_of) -> list[tuple]:
    """The rows of one saved filter, one for each text of which a match must hold one."""
    title, topic = spec.get("title_filter"), spec.get("filter")
    java = [js_regex(p) if p else None for p in (title, topic)]
    for p in java:
        if p:
            validate_java_regex(spark, p)
    days = spec.get("posted_within_days")
    since = None
    if recency_predicate(days, as_of, F.lit(None)) is not None:  # checks the argument too
        since = as_of_ms(as_of) - float(days) * 86_400_000
        since = None if since != since else min(max(-(-since // 1), -(1 << 62)), 1 << 62)
    includes, excludes = _keywords(spec.get("location_includes")), _keywords(spec.get("location_excludes"))
    texts, kind = None, ""
    if title:
        texts, kind = required_literals(title), "t"
    if texts is None and includes is not None:
        texts, kind = [py_js_trim(str(w).lower()) for w in spec["location_includes"] if w and py_js_trim(str(w).lower())], "l"
        texts = None if any(not t.isascii() for t in texts) else texts
    if texts is None and topic:
        texts, kind = required_literals(topic), "p"
    every = [[f"{kind}{g}" for g in py_grams(t)] for t in texts] if texts is not None else [[ANY]]
    # a date that is not a number, and keywords that are all blank, match nothing
    if (days is not None and since is None) or includes == []:
        return []
    fixed = (java[0], java[1], None if since is None else int(since), days is not None, includes, excludes)
    return [(filter_id, own[0], own, every, *fixed) for own in every]


def _prefixed(kind: str):
    return lambda g: F.concat(F.lit(kind), g)


def _listed(loc: Column, words: Column) -> Column:
    return F.exists(words, lambda k: F.when(k["word"], F.rlike(loc, k["text"])).otherwise(F.contains(loc, k["text"])))


def match_filters(postings: DataFrame, filters: dict[str, dict], limit=DEFAULT, *, as_of=None, partition_by=(), order_cols=ORDER_COLS) -> DataFrame:
    """``postings`` that pass each of many saved filters, with its ``filter_id``.

    ``filters`` maps an id to the arguments of ``apply_filters`` (title_filter, filter,
    posted_within_days, location_includes, location_excludes); the result is that of one call
    for each filter.  The limit counts for each filter and key ``partition_by``.

    Of most filters some text is known that every match must hold, a literal part of a pattern
    or a keyword.  A posting is looked up by its n-grams: only filters all of whose text's
    n-grams it has are tried on it, exactly.  Filters without such a text are tried on every
    posting.  Nothing is shuffled but for the limit.
    """
    spark = postings.sparkSession
    rows = [r for name, spec in filters.items() for r in _compiled(spark, str(name), spec, as_of)]
    table = spark.createDataFrame(rows, _FILTER)
    if sum(len(str(r)) for r in rows) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    needed = sorted({g for r in rows for g in r[2] if g != ANY})
    text = {"t": folded(F.col("title")), "l": folded(F.col("location")), "p": folded(F.concat_ws("\n", "title", "department", "description"))}
    keys = [F.array(F.lit(ANY))]
    for kind, column in text.items():
        own = [g[1:] for g in needed if g[0] == kind]
        if own:
            keys.append(F.transform(held_grams(column, own), _prefixed(kind)))
    looked = postings.withColumn("_keys", F.concat(*keys))
    tried = looked.select("*", F.explode("_keys").alias("key")).join(table.withColumnsRenamed({c: f"_f_{c}" for c in _FILTER.names if c not in ("filter_id", "key")}), "key")
    # of several texts of one filter that are there, the first one stands for all
    there = F.filter("_f_all", lambda t: F.size(F.array_except(t, F.col("_keys"))) == 0)
    tried = tried.where(F.get(there, 0) == F.col("_f_own"))
    matches = lambda c, p: F.rlike(F.coalesce(F.col(c), F.lit("")), F.col(p))
    loc = F.lower(F.coalesce(F.col("location"), F.lit("")))
    posted = F.col("posted_at") if "posted_at" in postings.columns else None
    if posted is None:
        from ..functions.dates import js_timestamp

        posted = js_timestamp("posted_at_raw")
    ok = F.col("_f_title").isNull() | matches("title", "_f_title")
    ok = ok & (~F.col("_f_dated") | F.coalesce(F.unix_millis(posted) >= F.col("_f_since"), F.lit(False)))
    ok = ok & (F.col("_f_includes").isNull() | _listed(loc, F.col("_f_includes"))) & (F.col("_f_excludes").isNull() | ~_listed(loc, F.col("_f_excludes")))
    ok = ok & (F.col("_f_topic").isNull() | matches("title", "_f_topic") | matches("department", "_f_topic") | matches("description", "_f_topic"))
    out = tried.where(ok).select("filter_id", *(F.col(c) for c in postings.columns))
    n = normalise_limit(limit)
    return out if n is None else first_n_per(out, n, ["filter_id", *partition_by], order_cols)
