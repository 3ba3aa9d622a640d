"""Explicit schemas: nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType

SIMPLE = {"string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(), "timestamp": TimestampType(), "binary": BinaryType()}


def _split(text: str) -> list[str]:
    """Parts between commas that no angle brackets enclose."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(text[last:i])
            last = i + 1
    return [x.strip() for x in [*out, text[last:]]]


def _type(text: str) -> DataType:
    kind, _, inner = text.partition("<")
    inner = inner[:-1]
    if kind == "array":
        return ArrayType(_type(inner))
    if kind == "map":
        key, value = _split(inner)
        return MapType(_type(key), _type(value))
    if kind == "struct":
        return StructType([StructField(n, _type(x)) for n, _, x in (f.partition(":") for f in _split(inner))])
    return SIMPLE[text]


def schema(ddl: str) -> StructType:
    """A schema from ``name type`` pairs; needs no session, so modules can hold schemas."""
    return StructType([StructField(n, _type(x)) for n, _, x in (f.partition(" ") for f in _split(ddl))])


PACKAGE = schema(
    "name string, version string, description string, repository string, keywords array<string>, categories array<string>, readme string, downloads bigint, github_stars bigint, "
    "dependencies array<struct<crate_id:string,kind:string>>, features array<struct<name:string,dependencies:array<string>>>, code_snippets array<string>, readme_sections map<string,string>, "
    "librs_downloads bigint, source string, enhanced_scraping map<string,struct<title:string,quality_score:double,extraction_method:string,structured_data:string,content_length:bigint>>, "
    "enhanced_features array<string>, enhanced_dependencies array<string>"
)
#: Columns that enrichment adds; free-form ones are JSON text.
ENRICHMENT = schema("readme_summary string, feature_summary string, use_case string, score double, factual_counterfactual string, source_analysis string, user_behavior string, security string")
ENRICHED = StructType(PACKAGE.fields + ENRICHMENT.fields)
SCRAPE = schema("name string, source string, url string, title string, content string, quality_score double, extraction_method string, structured_data string, error string, timestamp string")
TRACE = schema("execution_id string, timestamp string, input_data string, context_sources array<string>, reasoning_steps array<string>, suggestion string, verdict string, audit_info string, score double, registry_version string")
AUTHORITY = schema("key string, source string, version string, authority_level int, content_hash string, last_validated timestamp, expiry timestamp")
COMPLETION = schema("item string, batch bigint, finished timestamp, seconds double, status string, message string")
#: Tables of the knowledge base; JSON stays text.
KNOWLEDGE = {
    name: schema(ddl)
    for name, ddl in {
        "environment_metadata": "key string, value string, commit_hash string, timestamp string",
        "architectural_patterns": "pattern_name string, problem_description string, solution_description string, code_examples string, tags string, timestamp string",
        "hardware_profiles": "profile_name string, cpu string, memory_gb double, gpu string, models string, benchmarks string, timestamp string",
        "code_index": "file_path string, file_name string, file_extension string, function_name string, class_name string, module_name string, code_snippet string, docstring string, imports string, complexity_score double, lines_of_code bigint, content_hash string, timestamp string",
        "documentation_cache": "doc_type string, title string, content string, package_name string, tags string, relevance_score double, last_accessed string, content_hash string, timestamp string",
        "code_changes": "file_path string, change_type string, old_content string, new_content string, diff_summary string, commit_hash string, author string, timestamp string, impact_score double, tags string",
        "project_context": "context_key string, context_value string, active boolean, priority int, timestamp string",
        "agent_sessions": "session_id string, agent_type string, goals string, actions string, outcomes string, metrics string, timestamp string",
        "search_index": "title string, content string, source string, tags string",
        "provenance": "key string, hash string, signature binary, timestamp string",
        "policies": "policy_name string, description string, rank int, active boolean, updated_at string",
    }.items()
}


def default_of(field) -> Column:
    """What a missing value becomes: empty text, empty array or map, zero; ``null`` where the field allows it."""
    kind = field.dataType.typeName()
    if field.name == "librs_downloads" or field in ENRICHMENT.fields:
        return F.lit(None).cast(field.dataType)
    if field.name == "source":
        return F.lit("crates.io")
    return {"string": F.lit(""), "array": F.array().cast(field.dataType), "map": F.map_from_entries(F.array().cast(f"array<struct<k:string,v:{field.dataType.valueType.simpleString()}>>")) if kind == "map" else None}.get(kind, F.lit(0)).cast(field.dataType)


def empty_row(spark: SparkSession, name: str) -> DataFrame:
    """One package that nothing is known of but its name."""
    return spark.range(1).select(*[F.lit(name).alias("name") if f.name == "name" else default_of(f).alias(f.name) for f in PACKAGE.fields])
