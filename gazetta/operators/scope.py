"""Target lists: scope rules, filters, state targets and site candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions.text import identity, norm_search, slugify

# Population limits by state (capitals are always in there; elsewhere only capitals are),
# the words that a slug may leave out, and hosts that are never official.
LIMITS = {"SP": 30000, "MG": 15000, "SC": 15000, "PR": 15000, "RS": 15000, "RJ": 15000, "GO": 15000, "ES": 15000, "BA": 15000, "SE": 15000}
CONNECTORS = ["da", "de", "do", "das", "dos", "e"]
TOPONYMS = ["alto", "alta", "baixo", "baixa", "bela", "belo", "bom", "boa", "campo", "nova", "novo", "rio", "santa", "santo", "sao"]


def scope_filter(targets: DataFrame, rules: DataFrame, state: str = "state", population: str = "population", capital: str = "capital") -> DataFrame:
    """Targets in scope with the reason. ``rules``: one row a state (state, minimum); it is a small dimension.

    Population must exceed the minimum; capitals pass in any case, and alone where a state has no rule.
    """
    joined = targets.join(rules.withColumnRenamed("state", state), state, "left")
    grouped = F.regexp_replace(F.format_number(F.col("minimum"), 0), ",", ".")
    reason = (
        F.when(F.col("minimum").isNull() & F.col(capital), "Capital dos demais estados/DF")
        .when(F.col(population) > F.col("minimum"), F.concat(F.col(state), F.lit(" acima de "), grouped, F.lit(" habitantes")))
        .when(F.col("minimum").isNotNull() & F.col(capital), "Capital incluída pela regra da UF")
    )
    return joined.withColumn("reason", reason).where("reason IS NOT NULL").drop("minimum")


def limits(spark, table: dict[str, int] | None = None) -> DataFrame:
    return spark.createDataFrame(list((table or LIMITS).items()), "state string, minimum long")


def choose(targets: DataFrame, state: str | None = None, name: str | None = None, most: int | None = None, order: str = "ordinal") -> DataFrame:
    """Filters of a run: state, name without regard to accents, and a number of targets in order."""
    out = targets
    if state:
        out = out.where(F.upper(F.trim("state")) == state.strip().upper())
    if name:
        out = out.where(norm_search(F.col("name")) == norm_search(F.lit(name)))
    return out.orderBy(order).limit(most) if most else out


def sphere(df: DataFrame, wanted: str, col: str = "sphere") -> DataFrame:
    """Rows of one sphere; a table without the column is left as it is."""
    return df.where(F.lower(F.trim(col)) == wanted.lower()) if col in df.columns else df


def state_targets(municipal: DataFrame, config: DataFrame) -> DataFrame:
    """The government and the organs of every state that occurs. ``config``: state, government, site, organs array<struct<name, site, categories>>."""
    present = municipal.select("state").distinct().join(config, "state")
    own = present.select("state", F.col("government").alias("name"), "site", F.array().cast("array<string>").alias("categories"))
    organs = present.select("state", F.inline("organs")).where("name IS NOT NULL AND site IS NOT NULL").select("state", "name", "site", "categories")
    return own.unionByName(organs).withColumn("sphere", F.lit("Estadual"))


def slugs(name: Column) -> Column:
    """Up to four short forms of a name: whole, without connectors, first two words of either."""
    words = F.filter(F.split(norm_search(name), "[^a-z0-9]+"), lambda w: w != "")
    main = F.filter(words, lambda w: ~w.isin(CONNECTORS))

    def first_two(a: Column) -> Column:
        return F.when(F.size(a) >= 2, F.array_join(F.slice(a, 1, 2), "")).otherwise("")

    return F.array_distinct(F.filter(F.array(slugify(name), F.array_join(main, ""), first_two(main), first_two(words)), lambda s: F.length(s) >= 3))


def site_candidates(name: Column, state: Column) -> Column:
    """Likely addresses of a municipality, best first: eight for each short form."""
    uf = F.lower(state)

    def of_slug(s: Column) -> Column:
        hosts = [F.concat(s, F.lit("."), uf, F.lit(".gov.br")), F.concat(F.lit("prefeitura."), s, F.lit("."), uf, F.lit(".gov.br"))]
        return F.array(*(F.concat(F.lit(f"{scheme}://{www}"), h, F.lit("/")) for h in hosts for scheme in ("https", "http") for www in ("", "www.")))

    return F.array_distinct(F.flatten(F.transform(slugs(name), of_slug)))


def resolve_sites(targets: DataFrame, live: DataFrame, searched: DataFrame | None = None) -> DataFrame:
    """The given site, else the first candidate that ``live`` (url, ok) names as up, else what a search found; with the state of the search.

    ``targets``: id, name, state, site. ``searched``: id, root, as ``delivery.search_sites`` gives it.
    """
    given = targets.withColumn("has", F.coalesce(F.trim("site") != "", F.lit(False)))
    asked = given.where("NOT has").select("id", F.posexplode(site_candidates(F.col("name"), F.col("state"))).alias("rank", "url"))
    found = asked.join(live.where("ok").select("url").distinct(), "url").groupBy("id").agg(F.min_by("url", "rank").alias("found"))
    out = given.join(found, "id", "left")
    out = out.join(searched.select("id", F.col("root").alias("searched")), "id", "left") if searched is not None else out.withColumn("searched", F.lit(None).cast("string"))
    how = F.when(F.col("has"), "").when(F.col("found").isNotNull(), "Site inferido.").when(F.col("searched").isNotNull(), "Site localizado por busca.").otherwise("Site oficial não localizado.")
    site = F.when(F.col("has"), F.trim("site")).otherwise(F.coalesce("found", "searched", F.lit("")))
    out = out.withColumns({"site": site, "site_notes": how})
    return out.withColumn("site_status", F.when(F.col("site") == "", "Site não localizado").otherwise("Encontrado")).drop("has", "found", "searched")


def names_a_place(person: Column, place: Column, state: Column) -> Column:
    """Whether what stands as a person's name is the place itself, or a part of its name."""
    p, m, s = identity(person), identity(place), identity(state)
    first = F.element_at(F.split(p, " "), 1)
    return F.coalesce(
        (p != "")
        & (
            (p == m)
            | (p == F.concat_ws(" ", m, s))
            | (F.regexp_replace(p, " (centro|norte|sul|leste|oeste)$", "") == m)
            | (F.startswith(m, F.concat(p, F.lit(" "))) & first.isin(TOPONYMS) & (F.size(F.split(p, " ")) >= 2))
        ),
        F.lit(False),
    )
