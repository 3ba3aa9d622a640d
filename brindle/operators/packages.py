"""Package records: defaults, widening, fallbacks, scraped documents, repository statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import quality_score, repository_of
from ..schemas import ENRICHMENT, PACKAGE, default_of


def with_defaults(raw: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """The package columns; missing and null values alike become the column's default, or only missing ones if nulls
    are kept."""
    have = set(raw.columns)

    def value(f) -> Column:
        if f.name not in have:
            return default_of(f)
        own = F.col(f.name).cast(f.dataType)
        return own if keep_nulls else F.coalesce(own, default_of(f))

    return raw.select(*[value(f).alias(f.name) for f in PACKAGE.fields])


def most_popular(packages: DataFrame, n: int = 10, score: str = "score", key: str = "name") -> DataFrame:
    """The ``n`` rows of the highest score, a missing one counting as 0, ties to the smaller key."""
    return packages.orderBy(F.coalesce(score, F.lit(0.0)).desc(), key).limit(n)


def widened(packages: DataFrame) -> DataFrame:
    """With null enrichment columns."""
    return packages.withColumns({f.name: F.lit(None).cast(f.dataType) for f in ENRICHMENT.fields if f.name not in packages.columns})


def fetched(packages: DataFrame, key: str = "name") -> DataFrame:
    """Without failed fetches: rows that lack their key."""
    return packages.where(F.col(key).isNotNull() & (F.col(key) != ""))


def on_forge(packages: DataFrame, column: str = "repository", host: str = "github.com") -> DataFrame:
    return packages.where(F.coalesce(F.col(column), F.lit("")).contains(host))


def by_priority(sources: list[DataFrame], key: str, order: tuple[str, ...] = ()) -> DataFrame:
    """For every key the row of the first source that has one: a chain of fallbacks over landed tables.

    Of several rows that a source has for a key it is the first by ``order``; without it, any.
    """
    ranked = None
    for k, source in enumerate(sources):
        part = source.withColumn("_source", F.lit(k))
        ranked = part if ranked is None else ranked.unionByName(part, allowMissingColumns=True)
    first = Window.partitionBy(key).orderBy("_source", *order)
    return ranked.withColumn("_first", F.row_number().over(first)).where("_first = 1").drop("_first", "_source")


def merged(crate: DataFrame, readme: DataFrame, dependencies: DataFrame, features: DataFrame, stars: DataFrame) -> DataFrame:
    """One record per name from separately landed answers; each of the others may lack a name."""
    out = crate.select("name", *[c for c in crate.columns if c not in ("name", "readme", "dependencies", "features", "github_stars")])
    for part in (readme.select("name", "readme"), dependencies.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("crate_id", "kind"))).alias("dependencies")), features.select("name", "features"), stars.select("name", "github_stars")):
        out = out.join(part, "name", "left")
    return with_defaults(out)


def repository_statistics(urls: DataFrame, stats: DataFrame, column: str = "repository") -> DataFrame:
    """``url, owner, repo, stars``: statistics by owner and name for every distinct link that names a repository."""
    wanted = urls.select(F.col(column).alias("url")).distinct().withColumn("_r", repository_of(F.col("url"))).where("_r IS NOT NULL")
    return wanted.select("url", "_r.owner", "_r.repo").join(stats, ["owner", "repo"], "left")


def with_stars(packages: DataFrame, stats: DataFrame) -> DataFrame:
    """Stars by repository link: 0 where the link matched without a number, the old value where nothing matched."""
    found = stats.select(F.col("url").alias("_url"), F.col("stars").alias("_stars"), F.lit(True).alias("_hit"))
    joined = packages.join(found, F.col("repository") == F.col("_url"), "left")
    return joined.withColumn("github_stars", F.when(F.col("_hit"), F.coalesce("_stars", F.lit(0))).otherwise(F.col("github_stars"))).drop("_url", "_stars", "_hit")


def with_scrapes(packages: DataFrame, scrapes: DataFrame, order: str = "position") -> DataFrame:
    """Scraped pages put into packages: a longer readme of good quality from the documentation site, the last source's
    features and dependencies, all examples appended, and a summary of every page by source."""
    ok = scrapes.where("error IS NULL")
    data = F.from_json("structured_data", "features array<string>, dependencies array<string>, examples array<string>")
    pages = ok.withColumn("_d", data)
    docs = F.when((F.col("source") == "docs") & (F.col("quality_score") > 0.7), F.struct(F.col(order).alias("o"), F.col("content").alias("content")))
    last = lambda field: F.max_by(f"_d.{field}", F.when(F.col(f"_d.{field}").isNotNull(), F.col(order)))
    folded = pages.groupBy("name").agg(
        F.max(docs).alias("_doc"),
        last("features").alias("_features"),
        last("dependencies").alias("_dependencies"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce("_d.examples", F.array().cast("array<string>")).alias("x")))), lambda s: s["x"])).alias("_examples"),
        F.map_from_entries(F.collect_list(F.struct("source", F.struct("title", "quality_score", "extraction_method", "structured_data", F.char_length("content").cast("bigint").alias("content_length"))))).alias("_pages"),
    )
    joined = packages.join(folded, "name", "left")
    longer = F.col("_doc").isNotNull() & (F.char_length("_doc.content") > F.char_length(F.coalesce("readme", F.lit(""))))
    return joined.withColumns(
        {
            "readme": F.when(longer, F.col("_doc.content")).otherwise(F.col("readme")),
            "enhanced_features": F.coalesce("_features", "enhanced_features"),
            "enhanced_dependencies": F.coalesce("_dependencies", "enhanced_dependencies"),
            "code_snippets": F.concat("code_snippets", F.coalesce("_examples", F.array().cast("array<string>"))),
            "enhanced_scraping": F.coalesce("_pages", "enhanced_scraping"),
        }
    ).drop("_doc", "_features", "_dependencies", "_examples", "_pages")


def scrape_results(names: DataFrame, pages: DataFrame) -> DataFrame:
    """A row for every name and site, with ``error`` and the method ``failed`` where no page was landed."""
    sites = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(k).alias("position")) for k, s in enumerate(("crates_io", "docs", "lib_rs"))])
    wanted = names.select("name", F.explode(sites).alias("s")).select("name", "s.*")
    joined = wanted.join(pages, ["name", "source"], "left")
    failed = F.col("content").isNull()
    return joined.withColumns({"error": F.when(failed, F.coalesce("error", F.lit("no page"))), "extraction_method": F.when(failed, F.lit("failed")).otherwise(F.col("extraction_method")), "quality_score": F.when(failed, F.lit(0.0)).otherwise(quality_score(F.col("content"), F.col("structured_data")))})


def split_on_error(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    return results.where("error IS NULL"), results.where("error IS NOT NULL")


def package_of_scrape(scrape: DataFrame, suggestion: Column | None = None) -> DataFrame:
    """A package record of a scraped page; the description falls back to a suggestion, then to a fixed text."""
    d = F.from_json("structured_data", "description string, version string, repository string, keywords array<string>, downloads bigint")
    described = scrape.withColumn("_d", d)
    return with_defaults(described.select("name", F.coalesce("_d.description", F.lit(None).cast("string") if suggestion is None else suggestion, F.lit("no description")).alias("description"), F.coalesce("_d.version", F.lit("latest")).alias("version"), "_d.repository", "_d.keywords", "_d.downloads", F.col("content").alias("readme")))


def issues_of(issues: DataFrame) -> DataFrame:
    """Issues and pull requests apart, six fields each; a pull request has the key of that name."""
    return issues.select("number", "title", "state", "created_at", "closed_at", F.col("html_url").alias("url"), F.when(F.col("pull_request").isNotNull(), "pull_request").otherwise("issue").alias("kind"))


def commit_activity(commits: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """``keys, week, total``: commits by the week that begins on Monday."""
    return commits.groupBy(*keys, F.date_trunc("week", date).alias("week")).agg(F.count(F.lit(1)).alias("total"))


def forge_activity(packages: DataFrame, issues: DataFrame, activity: DataFrame, key: str = "name") -> DataFrame:
    """What users do, for every package on the forge: counts of issues and requests, and commits; nothing for others."""
    on = on_forge(packages).select(key)
    counted = issues.groupBy(key).agg(F.count_if(F.col("kind") == "issue").alias("issues"), F.count_if(F.col("kind") == "pull_request").alias("requests"))
    commits = activity.groupBy(key).agg(F.sum("total").alias("commits"))
    return on.join(counted, key, "left").join(commits, key, "left").fillna(0, ["issues", "requests", "commits"])


def version_adoption(versions: Column, most: int = 10) -> Column:
    """A map from the first versions to their downloads and date."""
    return F.map_from_entries(F.transform(F.slice(versions, 1, most), lambda v: F.struct(v["num"].alias("num"), F.struct(v["downloads"].alias("downloads"), v["created_at"].alias("created_at")))))


def normal_dependencies(deps: Column, most: int = 5) -> Column:
    """Of the first few, the ones of the normal kind that have an id."""
    return F.filter(F.slice(deps, 1, most), lambda d: (d["kind"] == "normal") & d["crate_id"].isNotNull())


def last_of(df: DataFrame, key: str, order: Column) -> DataFrame:
    """Of rows with one key the last: a later record replaces an earlier one."""
    return df.withColumn("_last", F.row_number().over(Window.partitionBy(key).orderBy(order.desc()))).where("_last = 1").drop("_last")
