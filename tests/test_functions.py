"""Expressions against plain Python written for the purpose, and golden values."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from brindle.functions import answers, code, redact, scores, text, trust, values


def col(spark, f, *inputs, kind="string"):
    rows = spark.createDataFrame([(i, *x) if isinstance(x, tuple) else (i, x) for i, x in enumerate(inputs)], f"i int, c {kind}" if not isinstance(inputs[0], tuple) else "i int, " + ", ".join(f"c{k} {kind}" for k in range(len(inputs[0]))))
    names = rows.columns[1:]
    return [r[1] for r in rows.select("i", f(*map(F.col, names)).alias("x")).orderBy("i").collect()]


def sections(content):
    out, now = [], ["Introduction", "", 10]
    for line in content.splitlines():
        if re.match(r"#+\s+", line):
            out.append(now)
            name = re.sub(r"^#+\s+", "", line)
            rank = next((p for p, words in text.PRIORITIES if re.search(rf"\b({words})\b", name, re.I)), 5)
            now = [name, line + "\n", rank]
        else:
            now[1] += line + "\n"
            if "```rust" in line or "```no_run" in line:
                now[2] = max(8, now[2])
    return [s for s in [*out, now] if s[1].strip()]


def truncated(content, most):
    if not content or len(content) // 4 <= most:
        return content or ""
    out, used = "", 0
    for name, body, _ in sorted(sections(content), key=lambda s: -s[2]):
        piece = f"## {name}\n{body}\n"
        if used + len(piece) // 4 <= most:
            out, used = out + piece, used + len(piece) // 4
        elif used < most - 100:
            room = 4 * (most - used)
            return out + (piece[:room] + "..." if len(piece) > room else piece)
    return out


def test_smart_truncate(spark):
    rng = random.Random(5)
    lines = ["# Usage", "## About it", "### Install", "# API", "# Other", "", "text " * 30, "```rust", "let x = 1;", "```", "é\u2028ü " * 9, "word\r\nword", "#no header", "#\ttab"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 40))) + rng.choice(["", "\n"]) for _ in range(150)]
    for most in (60, 150, 400):
        assert col(spark, lambda c: text.smart_truncate(c, most), *texts, None) == [truncated(t, most) for t in texts] + [""]


def test_truncate_prefix(spark):
    assert col(spark, lambda c: text.truncate_prefix(c, 3), "aaaa\n\nbbbbbbbb\n\ncccc", "a" * 40, "", None) == ["aaaa\n\nbbbbbbbb", "", "", ""]


def test_names_and_repositories(spark):
    assert col(spark, text.canonical_name, "  Crate:Tokio ", "rust:x", "crate:rust:y") == ["tokio", "x", "y"]
    found = col(spark, text.repository_of, "https://github.com/a/foo.rs.git", "git@github.com:b/c", "https://x.org/a/b", None)
    assert [tuple(x) if x else None for x in found] == [("a", "foo.rs"), ("b", "c"), None, None]
    assert col(spark, lambda c: text.repository_of(c, "to_dot")["repo"], "https://github.com/a/foo.rs") == ["foo"]


def test_readme(spark):
    assert col(spark, text.readme_sections, "hello\n# My Part\nx\ny\n# My Part\nz\n# Empty", "", None) == [{"intro": "hello", "my_part": "z"}, {}, {}]
    assert col(spark, text.code_snippets, "```rust\nlet x = 12345;\n```\n```\nshort\n```", None) == [["let x = 12345;"], []]
    assert col(spark, text.title_of, "a\n# T x \n# U", "\n\n\n\n\n# late", None) == ["T x", "Untitled", "Untitled"]
    assert col(spark, text.quality_score, "", None, "x" * 101, "Title " + "x" * 600, "x" * 1001) == [0.0, 0.0, 1.0, 3.0, 3.0]
    assert col(spark, lambda c: text.quality_score(F.lit("x" * 101), c), "{}", '{"a": 1}') == [1.0, 3.0]
    assert col(spark, text.download_count, "1,234 downloads", "none") == [1234, None]


SOURCE = """pub struct A { x: i32 }
enum B { C }
trait D { fn d(&self); }
impl D for A { fn d(&self) { if true { } } }
fn e() {}
fn g<T>(t: T) {}
"""


def test_code(spark):
    m = col(spark, code.code_metrics, SOURCE, "", None)
    assert (m[0].functions, m[0].structs, m[0].enums, m[0].traits, m[0].complexity, m[0].lines_of_code) == (3, 1, 1, 1, 2, 7)
    assert (m[1].functions, m[1].lines_of_code) == (0, 1)
    s = col(spark, code.code_symbols, SOURCE, "")
    assert (s[0].functions, s[0].types, s[0].traits, s[0].loc, s[1].loc) == (["d", "d", "e", "g"], ["A"], ["D"], 6, 0)
    paths = spark.createDataFrame([("a/src/x.rs",), ("a/tests/y.rs",), ("Cargo.toml",)], "p string")
    assert tuple(paths.agg(*code.structure_flags(F.col("p"))).first()) == (True, True, True, False)
    assert tuple(paths.limit(0).agg(*code.loose_flags(F.col("p"))).first()) == (False, False, False)
    assert col(spark, code.extension, "a/b.tar.gz", ".git", "x", "a.b/c") == [".gz", "", "", ""]


def test_trust(spark):
    got = col(spark, lambda q, s: trust.verdict(q.cast("double"), s)["verdict"], ("8.0", None), ("6.0", "positive"), ("6.0", None), ("3.9", "positive"), ("5.0", "negative"), ("5.0", None), (None, "negative"))
    assert got == ["ALLOW", "ALLOW", "DEFER", "DENY", "FLAG", "DEFER", "FLAG"]
    assert col(spark, lambda c: F.round(trust.confidence(F.lit(31), F.lit(8), c), 6), "DEFER", "ALLOW", "DENY") == [8.6, 9.6, 9.1]
    assert col(spark, lambda c: trust.execution_id(c, F.lit("12345678-9"), F.lit(7)), "tokio", "regex") == ["exec-434de5e6-12345678-7", "exec-42d58222-12345678-7"]


def test_scores(spark):
    pairs = [("\n" * 9, "\n" * 4), ("\n" * 9, "\n" * 3), ("", "x"), ("a\nb", "c\nd"), (None, "")]
    assert col(spark, scores.change_impact, *pairs) == [0.5, 0.6, 1.0, 0.0, 0.0]
    assert col(spark, lambda a, b: scores.impact_tag(scores.change_impact(a, b)), *pairs[:4]) == ["medium_impact", "high_impact", "high_impact", "low_impact"]
    numbers = [("30", "10"), ("10", "30"), ("150", "120"), ("20", "15")]
    as_int = lambda f: lambda a, b: f(a.cast("int"), b.cast("int"))
    assert col(spark, as_int(scores.change_type), *numbers) == ["feature_addition", "cleanup_removal", "major_refactor", "minor_change"]
    assert col(spark, as_int(scores.commit_impact), *numbers) == [4.0, 4.0, 10.0, 3.5]


def test_redact(spark):
    token, cloud = "ghp_" + "a1" * 18, "AKIA" + "ABCD" * 4
    got = col(spark, redact.redact, f"t {token} {cloud}", 'api_key = "abc"', "my_secret: 'xyz'", "a@b.org 10.1.2.3 +1 (555) 123-4567", None)
    assert token not in got[0] and cloud not in got[0] and got[1] == "[API_KEY_REDACTED]" and "xyz" not in got[2]
    assert got[3] == "[EMAIL_ADDRESS] [IP_ADDRESS] [PHONE_NUMBER]" and got[4] is None
    nested = spark.sql("SELECT named_struct('user', named_struct('c', 'a@b.org', 'n', 1), 'logs', array('x@y.org'), 'm', map('k', 'p@q.org')) AS r, 'keep@it.org' AS s")
    row = redact.sanitise(nested, True, ["r"]).first()
    assert (row.r.user.c, row.r.user.n, row.r.logs, row.r.m, row.s) == ("[EMAIL_ADDRESS]", 1, ["[EMAIL_ADDRESS]"], {"k": "[EMAIL_ADDRESS]"}, "keep@it.org")
    assert redact.sanitise(nested) is nested


def test_answers(spark):
    assert col(spark, answers.category_of, "It is a web framework.", "AI and database", "none of these", "", "said<|end|>ML") == ["Web Framework", "AI", "Unknown", "", "Unknown"]
    assert col(spark, answers.score_of, "Score: 7.5/10", "42", "0", "n/a", "", None) == [7.5, 10.0, 0.0, 5.0, 5.0, 5.0]
    assert col(spark, lambda c: answers.score_of(c, 1.0), "0") == [1.0]
    raw = "✅ Factual: a\n❌ Counterfactual: b\n✅ Factual: c\n❌ Counterfactual: d\n✅ Factual: e"
    assert col(spark, answers.fact_pairs, raw) == ["✅ Factual: a\n❌ Counterfactual: b\n\n✅ Factual: c\n❌ Counterfactual: d"]
    assert col(spark, answers.valid_category, "it is ml", "xyz") == [True, False]
    assert col(spark, lambda c: answers.simpler_prompt(c, 5), "a  b\n\n\nc d") == ["a b\nc..."]


def test_values(spark):
    assert col(spark, values.extracted_json, '{"a": 1}', "plain", "", None) == ['{"a": 1}', '{"raw_content":"plain"}', "{}", "{}"]
    assert col(spark, values.content_hash, "abc")[0][:8] == "ba7816bf"


@pytest.mark.parametrize("total", [100, 4096])
def test_split_budget(total):
    assert values.split_budget(total) == {"description": total // 5, "readme": total * 3 // 5}


def test_long_markdown_takes_the_time_of_its_text(spark):
    made = "intro\n" + "".join(f"## part {k}\nline {k}\n" for k in range(10_000)) + "## part 7\nlast"
    began = time.monotonic()
    df = spark.createDataFrame([(made,)], "c string").select(F.size(text.sections(F.col("c"))).alias("n"), text.smart_truncate(F.col("c"), 100).alias("cut"), text.readme_sections(F.col("c")).alias("m"))
    got = df.first()
    assert got.n == 10_002 and got.cut.startswith("## Introduction\nintro\n") and len(got.m) == 10_001 and got.m["part_7"] == "last"
    assert time.monotonic() - began < 60


def test_long_runs_without_a_match_take_linear_time(spark):
    runs = ["a_" * 500_000, "key_" * 250_000, "secret-" * 150_000, "x.y+" * 250_000, "a.b" * 100 + "@" + "c." * 200_000 + "d"]
    began = time.monotonic()
    got = [r.c for r in spark.createDataFrame([(r,) for r in runs], "c string").select(redact.redact(F.col("c")).alias("c")).collect()]
    assert got[:4] == runs[:4] and got[4] == "[EMAIL_ADDRESS]"
    assert time.monotonic() - began < 60


def test_linear_patterns_find_what_the_plain_ones_find(spark):
    rng = random.Random(5)
    parts = ["key", "secret", "a", "_", ".", "-", "=", ":", " ", "'", '"', "@", "b.co", "K", "\n", "+"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(1, 40))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "c string")
    plain = dict((*redact.SECRETS, *redact.PERSONAL))
    for name, pattern in redact.LINEAR.items():
        assert df.where(F.regexp_replace("c", plain[name], "#") != F.regexp_replace("c", pattern, "#")).count() == 0, name
