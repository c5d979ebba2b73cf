"""Gazetteer building, name matching and place finding in free text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasweave.functions.text import NameRule, normalize_name
from atlasweave.session import appended, scratch_path, stored


def gazetteer(units: DataFrame, rule: NameRule = normalize_name) -> DataFrame:
    """Every name of every level-1 and level-2 unit: main, variant and native.

    -> (iso3, admin_level, norm_name, gid), distinct; empty names are dropped.
    """
    names = F.concat(
        F.array(F.col("name")),
        F.coalesce(F.col("var_names"), F.array().cast("array<string>")),
        F.coalesce(F.col("nl_names"), F.array().cast("array<string>")),
    )
    return (
        units.where(F.col("admin_level").isin(1, 2))
        .select("iso3", "admin_level", "gid", F.explode(names).alias("raw_name"))
        .select("iso3", "admin_level", rule(F.col("raw_name")).alias("norm_name"), "gid")
        .where(F.col("norm_name") != "")
        .distinct()
    )


def best_unit_per_name(names: DataFrame) -> DataFrame:
    """(iso3, norm_name) -> one unit: lowest level first, then smallest gid."""
    return names.groupBy("iso3", "norm_name").agg(
        F.min(F.struct("admin_level", "gid")).alias("unit")
    ).select("iso3", "norm_name", F.col("unit.admin_level").alias("admin_level"), F.col("unit.gid").alias("gid"))


def match_names(
    df: DataFrame, names: DataFrame, iso3: str, place: str, rule: NameRule = normalize_name
) -> DataFrame:
    """Attach ``gid`` and ``admin_level`` to each place; null when there is no unit.

    Exact match of the normalised name inside the country, level 1 before
    level 2. The lookup side has one row per key, so no row is multiplied.
    """
    best = best_unit_per_name(names).withColumnsRenamed({"iso3": "_iso", "norm_name": "_name"})
    keyed = df.withColumn("_place", rule(F.col(place)))
    return keyed.join(
        best, (F.col(iso3) == F.col("_iso")) & (F.col("_place") == F.col("_name")), "left"
    ).drop("_iso", "_name", "_place")


def unmatched_names(matched: DataFrame, iso3: str, place: str, region: str) -> DataFrame:
    """Distinct (iso_code, place, region) of the places without a unit."""
    return (
        matched.where(F.col("gid").isNull())
        .select(F.col(iso3).alias("iso_code"), F.col(place).alias("place"), F.col(region).alias("region"))
        .distinct()
    )


def match_rate(matched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of matched places per group, in per cent."""
    return matched.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_places"),
        F.count("gid").alias("n_matched"),
        F.round(100.0 * F.count("gid") / F.count(F.lit(1)), 2).alias("match_pct"),
    )


def alias_table(mapping: DataFrame, levels: Sequence[int] = (1, 2)) -> DataFrame:
    """(level, iso3, alias) -> main name of the first mapping row that lists the alias.

    ``mapping`` has ``iso3, seq, main{level}, alt{level}, local{level}``; alt and
    local are pipe lists.
    """
    empty = F.array().cast("array<string>")

    def names_of(level: int) -> Column:
        main, alt, local = (F.col(f"{p}{level}") for p in ("main", "alt", "local"))
        every = F.concat(
            F.array(main), F.coalesce(F.split(alt, r"\|"), empty), F.coalesce(F.split(local, r"\|"), empty)
        )
        return F.struct(F.lit(level).alias("level"), main.alias("main"), F.array_distinct(every).alias("aliases"))

    return (
        mapping.select("iso3", "seq", F.explode(F.array(*[names_of(n) for n in levels])).alias("m"))
        .select("iso3", "seq", "m.level", "m.main", F.explode("m.aliases").alias("alias"))
        .where(F.col("alias").isNotNull())
        .groupBy("level", "iso3", "alias")
        .agg(F.min_by("main", "seq").alias("main"))
    )


def _at_level(level: int):
    return lambda item: item["level"] == level


def alias_lookup(
    df: DataFrame, mapping: DataFrame, row_id: str, iso3: str, columns: Mapping[int, str]
) -> DataFrame:
    """Rewrite each name of the array columns to its main name; unknown names stay.

    ``columns``: level -> array column. Only the id, the country and the names
    take part in the exploded join, all levels in one pass; array order is kept.
    """
    table = alias_table(mapping, list(columns)).withColumnsRenamed({"iso3": "_iso", "level": "_lv"})
    empty = F.array().cast("array<string>")

    def items_of(level: int, column: str) -> Column:
        return F.transform(
            F.coalesce(F.col(column), empty),
            lambda name, at: F.struct(F.lit(level).alias("level"), at.alias("at"), name.alias("name")),
        )

    listed = F.concat(*[items_of(level, column) for level, column in columns.items()])
    items = df.select(row_id, F.col(iso3).alias("_c"), F.explode(listed).alias("i")).select(row_id, "_c", "i.*")
    hit = (F.col("_c") == F.col("_iso")) & (F.col("level") == F.col("_lv")) & (F.col("name") == F.col("alias"))
    renamed = (
        items.join(table, hit, "left")
        .groupBy(row_id)
        .agg(
            F.sort_array(
                F.collect_list(F.struct("level", "at", F.coalesce("main", "name").alias("name")))
            ).alias("_items")
        )
    )
    rewritten = {
        column: F.when(
            F.col("_items").isNotNull() & F.col(column).isNotNull(),
            F.transform(F.filter("_items", _at_level(level)), lambda s: s["name"]),
        ).otherwise(F.col(column))
        for level, column in columns.items()
    }
    return df.join(renamed, row_id, "left").withColumns(rewritten).select(*df.columns)


def contains_lookup(found: DataFrame, mapping: DataFrame, level: int) -> DataFrame:
    """(iso3, name) -> main name of the first mapping row whose text contains it.

    Case-insensitive containment in the main, alt or local text. Comparing all
    names with all rows of a country would be quadratic; instead each row's
    text is cut into all pieces of the lengths that really occur among the
    names of that country, reduced to the first row per piece, and joined on
    equality. ``found`` has distinct ``iso3, name``.
    """
    lengths = found.groupBy("iso3").agg(
        F.sort_array(F.collect_set(F.length("name"))).alias("lens")  # one entry per name length
    )
    wanted = found.select("iso3", F.lower("name").alias("piece")).distinct()
    texts = F.array(
        *[F.lower(F.coalesce(F.col(f"{p}{level}"), F.lit(""))) for p in ("main", "alt", "local")]
    )
    cuts = lambda t, n: F.transform(
        F.sequence(F.lit(1), F.length(t) - n + 1), lambda s: F.substr(t, s, n)
    )
    pieces = (
        mapping.join(lengths, "iso3")
        .select("iso3", "seq", F.col(f"main{level}").alias("main"), F.explode(texts).alias("t"), "lens")
        .select(
            "iso3", "seq", "main", "t", F.explode("lens").alias("n"),
        )
        .where(F.col("n").between(F.lit(1), F.length("t")))
        .select("iso3", "seq", "main", F.explode(F.array_distinct(cuts(F.col("t"), F.col("n")))).alias("piece"))
    )
    first = (
        pieces.join(wanted, ["iso3", "piece"], "left_semi")
        .groupBy("iso3", "piece")
        .agg(F.min_by("main", "seq").alias("main"))
    )
    return found.join(
        first.withColumnsRenamed({"iso3": "_iso"}),
        (F.col("iso3") == F.col("_iso")) & (F.lower("name") == F.col("piece")),
        "left",
    ).select("iso3", "name", "main")


def name_sets(mapping: DataFrame) -> DataFrame:
    """(iso3, level, name): the distinct place names of a mapping, level 0, 1, 2.

    Pipe lists are split and trimmed; empty names are dropped.
    """
    columns = {0: ["main0", "alt0"], 1: ["main1", "alt1", "local1"], 2: ["main2", "alt2", "local2"]}
    pairs = F.array(
        *[
            F.struct(F.lit(level).alias("level"), F.col(c).alias("text"))
            for level, cols in columns.items()
            for c in cols
        ]
    )
    return (
        mapping.select("iso3", F.explode(pairs).alias("p"))
        .select("iso3", F.col("p.level").alias("level"), F.explode(F.split("p.text", r"\|")).alias("name"))
        .select("iso3", "level", F.trim("name").alias("name"))
        .where(F.col("name") != "")
        .distinct()
    )


# --- fixed values: names that texts of a country use beside those of its mapping --
EXTRA_NAMES = [("CHN", 1, "Hong Kong"), ("CHN", 1, "Macau")]


def scanned_names(mapping: DataFrame) -> DataFrame:
    """(iso3, level, name) that texts are scanned for: the mapping's names and the extra ones of its countries."""
    names = name_sets(mapping)
    for iso3, level, name in EXTRA_NAMES:
        extra = mapping.where(F.col("iso3") == iso3).select("iso3", F.lit(level).alias("level"), F.lit(name).alias("name"))
        names = names.unionByName(extra)
    return names.distinct()


# A text alternates between runs of word characters and runs of everything else.
# Word boundaries lie exactly between two runs (and at a text end next to a
# word), so "name as a whole word or phrase" means "a sequence of whole runs".
_RUNS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
_WORD = r"^[\p{L}\p{N}_]"


def _runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_RUNS), F.lit(0))


def phrase_trie(listed: DataFrame) -> DataFrame:
    """Every beginning of every phrase (_iso, _phrase, name, level): (_iso, depth, prefix, ends, more, entries), stored.

    ``depth`` counts runs. ``ends``: a phrase ends here, of the ``entries`` (name, level); ``more``: a longer one goes on.
    """
    runs = F.col("_r")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(runs)),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(runs, F.lit(1), k), "").alias("prefix"), (k == F.size(runs)).alias("ends")),
    )
    entries = listed.groupBy("_iso", "_phrase").agg(F.sort_array(F.collect_set(F.struct("name", "level"))).alias("_entries"))
    nodes = entries.withColumn("_r", _runs(F.col("_phrase"))).select("_iso", "_entries", F.explode(prefixes).alias("p"))
    return stored(
        nodes.groupBy("_iso", "p.depth", "p.prefix").agg(
            F.bool_or("p.ends").alias("ends"), F.bool_or(~F.col("p.ends")).alias("more"),
            # one phrase ends in a node at most
            F.flatten(F.collect_list(F.when(F.col("p.ends"), F.col("_entries")))).alias("entries")),
        "phrase-trie",
    )


#: Texts are scanned in jobs of so many characters at least, and so many jobs at most.
WAVE_CHARS, WAVES = 16_000_000, 32


def scan_names(
    texts: DataFrame, names: DataFrame, row_id: str, iso3: str, text: str, broadcast_names: int = 300_000
) -> DataFrame:
    """All gazetteer names of a text's country found in it as whole words.

    Same matches as scanning with one alternation of the country's names, longest
    first, ignoring case: from the left, the longest name that starts there wins
    and the search goes on behind it. Built from equi joins with a trie of the names, one
    table per depth: a place of a text is looked up by its first run of characters,
    and only where some name begins like that is the next run put to it and looked up.
    Overlapping hits of a text are thinned from left to right. Tries of up to
    ``broadcast_names`` beginnings (counted) go to every task, so that only hits are
    shuffled; larger ones are joined by shuffling what is still being followed. Places and
    hits are many times the texts, so texts are scanned in waves (:data:`WAVES`, dealt
    by ``row_id``), and what one shuffled goes before the next.

    -> (row_id, iso3, name, level), one row per name entry that was found.
    """
    listed = names.where(F.col("name") != "").select(
        F.col("iso3").alias("_iso"), F.lower("name").alias("_phrase"), "level", "name"
    )
    trie = phrase_trie(listed)
    size = trie.agg(
        F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth"),
        F.bool_and((F.col("depth") > 1) | F.col("prefix").rlike(_WORD)).alias("words"),
    ).first()
    lookup = F.broadcast if size["n"] <= broadcast_names else lambda df: df
    chars = texts.agg(F.sum(F.length(text)).cast("double")).first()[0] or 0
    waves = int(min(WAVES, 1 + chars // WAVE_CHARS))
    path = scratch_path(texts.sparkSession, "names-found")
    for wave in range(waves):
        part = texts.where(F.pmod(F.xxhash64(row_id), F.lit(waves)) == wave) if waves > 1 else texts
        found = _scanned(part, trie, lookup, size["depth"] or 1, size["words"], row_id, iso3, text)
        appended(found, path)
    return texts.sparkSession.read.schema(found.schema).parquet(path)


def _scanned(texts: DataFrame, trie: DataFrame, lookup, deepest: int, words: bool | None, row_id: str, iso3: str, text: str) -> DataFrame:
    """:func:`scan_names` of one wave of texts. ``words``: every phrase begins with a word."""
    entries = trie.schema["entries"].dataType.simpleString()
    runs, total = F.col("runs"), F.size(F.col("runs"))
    # a text end is a word boundary only next to a word, so a first or last run
    # of other characters cannot be part of a phrase
    first = F.when(F.get(runs, F.lit(0)).rlike(_WORD), 1).otherwise(2)
    last = F.when(F.get(runs, total - 1).rlike(_WORD), total).otherwise(total - 1)
    # runs alternate, so a name that begins with a word begins at every second one
    starts = F.when(F.col("last") >= F.col("first"), F.sequence("first", "last", F.lit(2 if words else 1)))
    begun = F.transform(
        starts,
        lambda i: F.struct(
            i.alias("at"), F.get(runs, i - 1).alias("run"),
            F.slice(runs, i + 1, F.least(F.lit(deepest - 1), F.col("last") - i)).alias("rest")),
    )
    followed = (
        texts.select(F.col(row_id), F.col(iso3).alias("_c"), _runs(F.lower(text)).alias("runs"))
        .withColumns({"first": first, "last": last})
        .select(row_id, "_c", F.explode(begun).alias("p"))
        .select(row_id, "_c", "p.at", F.col("p.run").alias("phrase"), "p.rest")
    )
    for depth in range(1, deepest + 1):
        level = lookup(trie.where(F.col("depth") == depth).select(
            "_iso", F.col("prefix").alias("_node"), F.col("ends").alias("_ends"), F.col("more").alias("_more"), F.col("entries").alias("_entries")))
        hit = F.when(F.col("_ends"), F.array(F.struct(F.lit(depth).alias("n"), F.col("_entries").alias("entries")))).otherwise(
            F.array().cast(f"array<struct<n:int,entries:{entries}>>"))
        if depth == 1:
            met = followed.join(level, (F.col("_c") == F.col("_iso")) & (F.col("phrase") == F.col("_node"))).withColumn("found", hit)
        else:
            # a place that is followed no further asks for what no table has, each for something else
            asked = F.coalesce("phrase", F.concat(F.lit("\u0000"), F.col("at").cast("string"), F.col(row_id).cast("string")))
            met = followed.withColumn("_asked", asked).join(
                level, (F.col("_c") == F.col("_iso")) & (F.col("_asked") == F.col("_node")), "left"
            ).withColumn("found", F.concat("found", hit))
        # a null run (the text ends) makes a null phrase
        followed = met.select(
            row_id, "_c", "at", F.when(F.col("_more"), F.concat("phrase", F.get("rest", F.lit(depth - 1)))).alias("phrase"), "rest", "found")
    hits = followed.select(row_id, "_c", "at", F.explode("found").alias("f")).select(row_id, "_c", "at", "f.n", "f.entries")
    # Cut the hits of a text into groups that overlap; between groups nothing has
    # to be decided. All of this happens after one exchange on the text's id.
    along = Window.partitionBy(row_id).orderBy("at", F.col("n").desc())
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    grouped = (
        hits.withColumn("_reach", F.max(F.col("at") + F.col("n") - 1).over(earlier))
        .withColumn("_new", F.when(F.col("at") <= F.col("_reach"), 0).otherwise(1))
        .withColumn("_group", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(row_id, "_c", "_group")
        .agg(F.sort_array(F.collect_list(F.struct("at", (-F.col("n")).alias("neg_n"), "entries"))).alias("hits"))
    )
    # inside a group the leftmost hit wins, the longest of those, then the next behind it
    kept = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("upto"), F.array().cast(entries).alias("kept")),
        lambda acc, h: F.when(
            h["at"] > acc["upto"],
            F.struct(
                (h["at"] - h["neg_n"] - 1).alias("upto"),
                F.concat(acc["kept"], h["entries"]).alias("kept"),
            ),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )
    return grouped.select(row_id, F.col("_c").alias("iso3"), F.explode(kept).alias("e")).select(row_id, "iso3", "e.name", "e.level").distinct()


def answered_places(
    df: DataFrame,
    mapping: DataFrame,
    row_id: str,
    iso3: str,
    country: str,
    columns: Mapping[int, str],
    dissolved: str,
    successors: Sequence[tuple[str, str]],
) -> DataFrame:
    """All lookups of a row's places at once: :func:`resolve_by_evidence` and then :func:`alias_lookup`.

    Every place of a row is one question (country, name); a row of the dissolved country
    asks each successor. The answers are one table with a row per country and name: its
    main name at each level, and whether it is evidence. Questions are joined with it
    once and packed back per row. ``df`` is read twice, ``mapping`` once if it is stored.
    """
    alias = alias_table(mapping, list(columns)).select(
        F.col("iso3").alias("_iso"), F.col("alias").alias("_name"), F.col("level").alias("_lv"), F.col("main").alias("_main"), F.lit(False).alias("_ev"))
    codes = [code for code, _ in successors]
    evidence = name_sets(mapping.where(F.col("iso3").isin(codes))).where("level > 0").select(
        F.col("iso3").alias("_iso"), F.col("name").alias("_name"), F.lit(None).cast("int").alias("_lv"), F.lit(None).cast("string").alias("_main"), F.lit(True).alias("_ev"))
    answers = alias.unionByName(evidence).groupBy("_iso", "_name").agg(
        *[F.max(F.when(F.col("_lv") == level, F.col("_main"))).alias(f"_main{level}") for level in columns], F.bool_or("_ev").alias("_ev"))
    empty = F.array().cast("array<string>")

    def items_of(level: int, column: str) -> Column:
        return F.transform(
            F.coalesce(F.col(column), empty),
            lambda name, at: F.named_struct(F.lit("level"), F.lit(level), F.lit("at"), at, F.lit("name"), name))

    listed = F.concat(*[items_of(level, column) for level, column in columns.items()])
    asked = F.when(
        F.col(iso3) == dissolved, F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(code).alias("of")) for rank, code in enumerate(codes)])
    ).otherwise(F.array(F.struct(F.lit(None).cast("int").alias("rank"), F.col(iso3).alias("of"))))
    questions = (
        df.select(row_id, asked.alias("_asked"), listed.alias("_listed"))
        .select(row_id, "_listed", F.explode("_asked").alias("a"))
        .select(row_id, "a.rank", "a.of", F.explode("_listed").alias("q"))
        .select(row_id, "rank", "of", "q.*")
    )
    main = F.lit(None).cast("string")
    for level in columns:
        main = F.when(F.col("level") == level, F.col(f"_main{level}")).otherwise(main)
    packed = (
        questions.join(answers, (F.col("of") == F.col("_iso")) & (F.col("name") == F.col("_name")), "left")
        .groupBy(F.col(row_id).alias("_row"))
        .agg(
            F.min(F.when(F.col("_ev"), F.col("rank"))).alias("_rank"),
            F.sort_array(F.collect_list(F.struct("level", "at", "rank", F.coalesce(main, "name").alias("name")))).alias("_items"),
        )
    )
    # a column of its own: below, the country's name stands for the new country
    joined = df.withColumn("_old", F.coalesce(F.col(iso3) == dissolved, F.lit(False))).join(packed, F.col(row_id) == F.col("_row"), "left")
    old = F.col("_old")
    code, title = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rank, (c, t) in enumerate(successors):
        code = F.when(F.col("_rank") == rank, c).otherwise(code)
        title = F.when(F.col("_rank") == rank, t).otherwise(title)
    joined = joined.where(~old | F.col("_rank").isNotNull())

    def answered(level: int, column: str) -> Column:
        mine = F.filter("_items", lambda i: (i["level"] == level) & (F.coalesce(i["rank"], F.lit(-1)) == F.when(old, F.col("_rank")).otherwise(-1)))
        return F.when(F.col("_items").isNotNull() & F.col(column).isNotNull(), F.transform(mine, lambda i: i["name"])).otherwise(F.col(column))

    return joined.select(
        *[
            F.when(old, code).otherwise(F.col(iso3)).alias(c) if c == iso3
            else F.when(old, title).otherwise(F.col(country)).alias(c) if c == country
            else answered(next(n for n, x in columns.items() if x == c), c).alias(c) if c in columns.values()
            else F.col(c)
            for c in df.columns
        ]
    )


def resolve_by_evidence(
    df: DataFrame,
    names: DataFrame,
    row_id: str,
    iso3: str,
    country: str,
    place_columns: Sequence[str],
    dissolved: str,
    successors: Sequence[tuple[str, str]],
) -> DataFrame:
    """Give rows of a dissolved country to the first successor that has one of
    the row's places; rows without such evidence are dropped, other rows pass.

    ``names`` has ``iso3, name``. Only rows of the dissolved country are joined.
    """
    old = df.where(F.col(iso3) == dissolved)
    places = F.array_distinct(F.concat(*[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in place_columns]))
    order = F.lit(None).cast("int")
    for rank, (code, _) in enumerate(successors):
        order = F.when(F.col("_succ") == code, rank).otherwise(order)
    evidence = (
        old.select(row_id, F.explode(places).alias("_place"))
        .join(
            names.where(F.col("iso3").isin([c for c, _ in successors]))
            .select(F.col("iso3").alias("_succ"), F.col("name").alias("_place"))
            .distinct(),
            "_place",
        )
        .groupBy(row_id)
        .agg(F.min(order).alias("_rank"))
    )
    new_iso, new_country = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rank, (code, title) in enumerate(successors):
        new_iso = F.when(F.col("_rank") == rank, code).otherwise(new_iso)
        new_country = F.when(F.col("_rank") == rank, title).otherwise(new_country)
    resolved = (
        old.join(evidence, row_id)
        .withColumns({iso3: new_iso, country: new_country})
        .select(*df.columns)
    )
    return df.where(F.col(iso3).isNull() | (F.col(iso3) != dissolved)).unionByName(resolved)


def attach_units(places: DataFrame, units: DataFrame, iso3: str, level: str, name: str) -> DataFrame:
    """Inner join of place rows to units on (level, name) and country.

    A place row without a country matches units of any country. Each unit is
    therefore listed under its country and under a wildcard, and a place row
    looks up one of the two: a single equi join instead of an OR condition.
    """
    rest = [c for c in units.columns if c not in ("admin_level", "name", "iso3")]
    listed = units.select(
        F.col("admin_level").alias("_level"), F.col("name").alias("_name"),
        F.explode(F.array(F.col("iso3"), F.lit("*"))).alias("_iso"), *rest,
    )
    return places.join(
        listed,
        (F.col(level) == F.col("_level")) & (F.col(name) == F.col("_name"))
        & (F.coalesce(F.col(iso3), F.lit("*")) == F.col("_iso")),
    ).drop("_level", "_name", "_iso")
