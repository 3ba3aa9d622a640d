import json

from pyspark.sql import functions as F

from brindle.operators import enrich, graph, history, html, packages, progress, search, trust, verify
from brindle.plans import catalog
from brindle.schemas import ENRICHED, empty_row
from tests import compare


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def package(spark, *names_and_deps):
    made = spark.createDataFrame([(n, [(d, "normal") for d in deps]) for n, deps in names_and_deps], "name string, dependencies array<struct<crate_id:string,kind:string>>")
    return packages.with_defaults(made)


def test_graph(spark):
    p = package(spark, ("a", []), ("b", ["a", "a", "gone", "b"]), ("c", ["a"]))
    known = graph.known_edges(graph.edges_of(p), p)
    assert rows(graph.dependency_lists(p, known), "name") == [("a", []), ("b", ["a", "a", "b"]), ("c", ["a"])]
    assert rows(graph.reverse_lists(known), "name") == [("a", ["b", "b", "c"], 3), ("b", ["b"], 1)]
    assert rows(graph.most_depended(known, 1)) == [("a", 3)]


def test_defaults_and_fallbacks(spark):
    raw = spark.createDataFrame([("x", None)], "name string, downloads bigint")
    assert packages.with_defaults(raw).first().asDict(True)["downloads"] == 0
    assert packages.widened(packages.with_defaults(raw)).schema.names == ENRICHED.names
    assert empty_row(spark, "z").first().source == "crates.io"
    one = spark.createDataFrame([("a", 1)], "name string, v int")
    two = spark.createDataFrame([("a", 2), ("b", 2)], "name string, v int")
    assert rows(packages.by_priority([one, two], "name"), "name") == [("a", 1), ("b", 2)]
    stats = spark.createDataFrame([("u1", 5), ("u2", None)], "url string, stars bigint")
    mine = spark.createDataFrame([("u1", 1), ("u2", 1), ("u3", 1)], "repository string, github_stars bigint")
    assert rows(packages.with_stars(mine, stats), "repository") == [("u1", 5), ("u2", 0), ("u3", 1)]


def test_fallback_takes_the_first_row_stored(spark, tmp_path):
    folder = tmp_path / "lineitem.parquet"
    for name, n, quantity in (("a", 10, 1.0), ("b", 1000, 2.0), ("c", 100, 3.0)):  # larger files are read first
        made = spark.range(n).select((F.col("id") % 20).alias("l_orderkey"), (F.col("id") % 3 + 1).cast("int").alias("l_linenumber"), (F.lit(quantity) + F.col("id")).alias("l_quantity"))
        made.coalesce(1).write.parquet(str(tmp_path / name))
        folder.mkdir(exist_ok=True)
        next((tmp_path / name).glob("part-*.parquet")).rename(folder / f"{name}.parquet")
    found = catalog.queries()["source_fallback"](spark, str(tmp_path))
    db = compare.duck(str(tmp_path))
    db.execute("SET threads = 1")
    assert rows(found, "name") == sorted(db.sql(catalog.oracle_sql()["source_fallback"]).fetchall())


def test_scrapes(spark):
    p = package(spark, ("a", []), ("b", []))
    pages = spark.createDataFrame(
        [("a", "docs", 1, "long text", 3.0, "m", json.dumps({"features": ["f"], "examples": ["e1"]}), "T", None), ("a", "lib_rs", 2, "other", 1.0, "m", json.dumps({"features": ["g"], "examples": ["e2"]}), "U", None), ("b", "docs", 1, None, 0.0, "failed", None, None, "boom")],
        "name string, source string, position int, content string, quality_score double, extraction_method string, structured_data string, title string, error string",
    )
    a, b = packages.with_scrapes(p, pages).orderBy("name").collect()
    assert (a.readme, a.enhanced_features, a.code_snippets, sorted(a.enhanced_scraping)) == ("long text", ["g"], ["e1", "e2"], ["docs", "lib_rs"])
    assert (b.readme, b.code_snippets) == ("", [])


def test_registry_and_traces(spark):
    r = trust.default_registry(spark)
    s = trust.registry_summary(r).first()
    assert (s.total, s.valid, s.levels) == (4, 4, {6: 1, 7: 1, 8: 1, 10: 1})
    more = trust.register(r, spark.createDataFrame([("docs", "s", "c", None), ("new", "s", "c", 2)], "key string, source string, content string, authority_level int"))
    assert rows(more.select("key", "authority_level"), "key") == [("crates_registry", 10), ("directory", 6), ("docs", 5), ("forge", 8), ("new", 2)]
    assert trust.valid_sources(more).count() == 4 and trust.registry_summary(r.limit(0)).first().total == 0
    t = trust.analyse(spark.createDataFrame([("crate:Tokio",)], "name string"), r, shifted=True).first()
    assert (t.verdict, round(t.score, 6), len(t.reasoning_steps), len(t.context_sources)) == ("DEFER", 8.6, 9, 4)
    assert trust.analyse(spark.createDataFrame([("x",)], "name string"), r).first().verdict == "ALLOW"
    two = spark.createDataFrame([("ALLOW", 0.8), ("DENY", 0.6)], "verdict string, score double")
    s = trust.audit_summary(two).first()
    assert (s.total, s.verdicts, round(s.mean_score, 9)) == (2, {"ALLOW": 1, "DENY": 1}, 0.7)
    assert trust.audit_summary(two.limit(0)).first().total == 0


def test_history(spark):
    log = ["abc1234|Ann|2024-01-01|add x", "30\t10\tsrc/a.rs", "-\t-\timg.png", "", "1234567|Bob|2024-01-02|fix", "1\t1\tb.rs"]
    lines = spark.createDataFrame([("r", i, v) for i, v in enumerate(log)], "log string, n bigint, value string")
    changes = history.parse_log(lines)
    assert changes.count() == 3
    got = {r.commit: r for r in history.impact(changes).collect()}
    assert (got["abc1234"].impact_score, got["abc1234"].change_type, got["abc1234"].file_types) == (4.0, "feature_addition", {".png": 1, ".rs": 1})


def test_long_logs_are_spread(spark):
    kinds = {"a": lambda k: k % 9 == 3, "b": lambda k: k == 5, "c": lambda k: False, None: lambda k: k in (0, 80)}  # commit lines
    made, want = [], []
    for log, is_head in kinds.items():
        commit = None
        for k in range(100):
            if is_head(k):
                commit = f"{k:07x}"
                made.append((log, k - 50, f"{commit}|A|2024-01-01|s|t"))
            else:
                made.append((log, k - 50, f"{k}\t-\tf{k}"))
                want += [(str(log), commit, "s|t", f"f{k}", k, 0)] if commit else []
    lines = spark.createDataFrame(made[::-1], "log string, n bigint, value string")
    got = history.parse_log(lines, block=20).select(F.coalesce("log", F.lit("None")), "commit", "subject", "filename", "additions", "deletions", F.spark_partition_id()).collect()
    assert sorted(tuple(r)[:6] for r in got) == sorted(want)
    assert len({r[6] for r in got if r[0] == "b"}) > 1
    assert sorted(tuple(r)[1:] for r in history.parse_log(lines).drop("author", "date").where("log = 'b'").collect()) == sorted(x[1:] for x in want if x[0] == "b")


def test_search(spark, tmp_path):
    made = search.create_tables(spark, str(tmp_path))
    assert len(made) == 11 and search.create_tables(spark, str(tmp_path)) == []
    files = spark.createDataFrame([("a/b.py", 'import os\n"""x"""\nclass K:\n    def f(self):\n        pass\n'), ("c.rs", "fn main() {}")], "path string, text string")
    index = search.index_files(files)
    row = index.where("file_path = 'a/b.py'").first()
    assert (row.function_name, row.class_name, row.imports, row.lines_of_code) == ("f", "K", '["os"]', 5)
    search.append_rows(index, str(tmp_path), "code_index")
    assert search.not_indexed(index, search.table(spark, str(tmp_path), "code_index")).count() == 0
    df = spark.createDataFrame([(1, "50% off", 1.0, 1), (2, "5000 off", 2.0, 2)], "id int, title string, relevance double, ts int")
    assert [r.id for r in search.search([("s", df, ["title"], [F.col("id")])], "50% OFF").collect()] == [1]
    old, new = spark.createDataFrame([("k", 1), ("l", 1)], "k string, v int"), spark.createDataFrame([("k", 2)], "k string, v int")
    assert rows(search.upserted(old, new, ["k"]), "k") == [("k", 2), ("l", 1)]


def test_index_of_sources_that_cannot_be_parsed(spark):
    deep, folded = "(" * 10_000, "-" * 100_000 + "1"
    files = spark.createDataFrame([("a/deep.py", deep), ("folded.py", folded), ("nul.py", "a\0"), (None, "x = 1"), ("none.py", None)], "path string, text string")
    got = {r.file_path: (r.file_name, r.code_snippet, r.function_name) for r in search.index_files(files).collect()}
    assert got == {"a/deep.py": ("deep.py", deep[:1000], None), "folded.py": ("folded.py", folded[:1000], None), "nul.py": ("nul.py", "a\0", None), None: (None, "x = 1", None), "none.py": ("none.py", "", None)}


def test_verify(spark):
    ours = spark.createDataFrame([("a", 1, "r", ["x", "y"]), ("b", 2, "q", []), ("c", 3, "", None), (None, 1, "r", [])], "name string, downloads bigint, repository string, categories array<string>")
    theirs = spark.createDataFrame([("a", 1, "r", ["y", "x"]), ("b", 3, "z", ["x"])], "name string, downloads bigint, repository string, categories array<string>")
    got = {r.name: r for r in verify.verified(ours, theirs).collect()}
    assert got["a"].verified and set(got["a"].verified_fields) == {"downloads", "repository", "categories"}
    assert not got["b"].verified and set(got["b"].discrepancies) == {"downloads", "repository"}
    assert got["c"].verified and got["c"].verified_fields == [] and not got[None].verified
    s = verify.summary(verify.verified(ours, theirs)).first()
    assert (s.total, s.verified, s.failed, s.discrepancies) == (4, 2, 2, 2)
    assert verify.summary(verify.verified(ours.limit(0), theirs)).first().total == 0


def test_progress(spark):
    e = spark.createDataFrame([(i, "k", float(i)) for i in range(1, 6)], "id int, k string, s double")
    assert rows(progress.batches(e, ["id"], 2).select("id", "batch"), "id") == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)]
    assert [r.id for r in progress.admitted(e, ["k"], ["id"], "s", F.lit(3)).orderBy("id").collect()] == [1, 2, 3]
    p = progress.performance(e.limit(0), "s").first()
    assert (p["mean"], p["per_minute"]) == (0.0, 0.0)


def test_enrich(spark):
    p = package(spark, ("a", []), ("b", []))
    first, second = (enrich.enriched(p).orderBy("name").collect() for _ in range(2))
    assert first == second and first[0].use_case and first[0].factual_counterfactual.count("✅") == 3
    assert enrich.prompts(p, gating="unified").count() == 0
    calls = []

    def call(request):
        calls.append(request.temperature)
        return "bad"

    assert enrich.with_retries(call, enrich.Request("p", 0.5), lambda x: False, enrich.RETRIES["hosted"]) is None and calls[-1] == 0.8
    assert enrich.with_retries(call, enrich.Request("p", 0.5), lambda x: False, enrich.RETRIES["local"]) == "bad"
    asked = enrich.prompts(p)
    some = enrich.answered(asked, enrich.Settings(budget=0.5), cost_per_token=0.001)
    assert 0 < some.count() < asked.count()


def test_html(spark):
    page = '<html><title>t</title><h1>Name</h1><p class="description">D &amp; E</p><a href="https://github.com/a/b">x</a><div class="keywords"><a href="/k">kw</a></div><article>main <b>text</b></article>'
    got = html.extract(spark.createDataFrame([(1, page), (2, None), (3, "<p>open")], "page_id int, html string")).orderBy("page_id").collect()
    assert (got[0].title, got[0].description, got[0].forge_link, got[0].keywords, got[0].content) == ("Name", "D & E", "https://github.com/a/b", ["kw"], "main text")
    assert got[1].title is None and got[2].content == "open"


def test_page_facts_of_odd_markup(spark, tmp_path):
    odd = [None, "<h1>a &amp;&amp</h1>", "<h1>a &amp</h1><h1>b</h1>", "<title>t</title>", "", None, "<H1>x</H1><A HREF=1>", "<h1 id=1> \u00a0<b>x</b>\n</h1 ><a\nhref=1></h1>", "<h1>open", "<h1><h1>a<>b<c</h1>"]
    odd += ["<h1>&#39;&nbsp;&amp;lt;&lt;b&gt;</h1>", '<!-- <a href="x"> --><a data-href=""><a <a href=1 href=2', "<script>'<a id=1 href='</script><a href=''>x</a><a name=1>", "<h1\n>\ta </h1><a \nhref=1", "<article><a>href=</article>"]
    spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = catalog.queries()["page_facts"](spark, str(tmp_path))
    assert rows(found, "page_id") == sorted(compare.duck(str(tmp_path)).sql(catalog.oracle_sql()["page_facts"]).fetchall())


def test_budget_stops_calls(spark):
    asked = spark.createDataFrame([(f"p{k}", "general", "say so", 1) for k in range(50)], "name string, task string, prompt string, tokens bigint")
    done = enrich.answered(asked, enrich.Settings(max_tokens=9, budget=1.0), cost_per_token=0.01)
    assert sorted(r.name for r in done.collect()) == sorted(f"p{k}" for k in range(50))[:11]
    p = packages.with_defaults(spark.createDataFrame([("a", "# Title\ntext"), ("b", "")], "name string, readme string"))
    free, none = enrich.enriched(p), enrich.enriched(p, enrich.Settings(budget=-1.0, cost_per_token=1.0))
    assert free.where("use_case IS NOT NULL").count() == 2 and none.where("use_case IS NOT NULL").count() == 0 and none.count() == 2


def test_extraction_by_model(spark):
    pages = spark.createDataFrame([("a", "first page\nof a"), ("b", None)], "name string, content string")
    got = {r.name: json.loads(r.structured_data) for r in enrich.extracted(pages, {"description": "string", "version": "string"}).collect()}
    assert got["a"] == {"description": "of a", "version": "of a"} and set(got) == {"a", "b"}
    assert enrich.local_prompt("x" * 50, margin=105) == "x" * 20 and enrich.local_prompt("x", margin=0) == ""


def test_running_sums_over_one_key(spark):
    df = spark.range(1000).select(F.lit(None).cast("string").alias("k"), "id", (F.col("id") % 7).alias("v"))
    out = progress.running_sums(df, ["k"], ["id"], {"s": F.col("v")})
    assert [r.s for r in out.orderBy("id").collect()] == [sum(i % 7 for i in range(k)) for k in range(1000)]


def test_forge_activity(spark):
    p = packages.with_defaults(spark.createDataFrame([("a", "https://github.com/o/a"), ("b", "https://example.org"), ("c", "https://github.com/o/c")], "name string, repository string"))
    issues = spark.createDataFrame([("a", "issue"), ("a", "issue"), ("a", "pull_request"), ("b", "issue")], "name string, kind string")
    commits = spark.createDataFrame([("a", 3), ("a", 4)], "name string, total long")
    assert rows(packages.forge_activity(p, issues, commits), "name") == [("a", 2, 1, 7), ("c", 0, 0, 0)]


def test_rolling_over_blocks(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), "id", (F.col("id") * 7 % 31).alias("v"))
    got = {r.id: (r.n, r.mean, r.low, r.high) for r in progress.rolling(df, ["k"], ["id"], "v", rows=7, block=20).collect()}
    for i in range(500):
        own = [j * 7 % 31 for j in range(i % 2, i + 1, 2)][-7:]
        assert got[i] == (len(own), sum(own) / len(own), min(own), max(own))
