"""What a run knows of its machine, repository and project: rows for the knowledge base, made on the driver."""

from __future__ import annotations

import hashlib
import json
import logging
import os
import platform
import resource
import shutil
import subprocess
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KNOWLEDGE

#: Calls left under which a service counts as nearly used up.
FEW_CALLS = 100
SYMBOLS = {"PASS": "✅", "FAIL": "❌", "WARN": "⚠️", "ERROR": "💥"}
PLAIN_SYMBOLS = {"PASS": "[OK]", "FAIL": "[FAIL]", "WARN": "[WARN]", "ERROR": "[ERROR]"}


def rate_limit(answer: dict, few: int = FEW_CALLS) -> tuple[int, bool]:
    """Calls left by a service's own account of its limits, and whether they are few; an answer without one has none left."""
    left = int(((answer.get("resources") or {}).get("core") or {}).get("remaining") or 0)
    return left, left < few


def token_problem(token: str | None, least: int = 20) -> str | None:
    """What is wrong with an access token before it is used, None if nothing is."""
    if not token:
        return "no token"
    if token != token.strip() or any(c.isspace() for c in token):
        return "white space in the token"
    return None if len(token) >= least else "the token is too short"


def _git(repo: str, *arguments: str) -> str:
    try:
        done = subprocess.run(["git", "-C", repo, *arguments], capture_output=True, text=True, errors="replace")
    except OSError:
        return ""
    return done.stdout if done.returncode == 0 else ""


def head_hash(repo: str, path: str | None = None) -> str:
    """The commit that last changed a file, or the newest one; empty where there is none."""
    return _git(repo, "log", "-1", "--format=%H", *(["--", path] if path else [])).strip()


def content_at(repo: str, commit: str, path: str) -> str | None:
    """A file's text at a commit, None if the commit has no such file."""
    if commit.startswith("-") or not _git(repo, "cat-file", "-t", f"{commit}:{path}").startswith("blob"):
        return None
    return _git(repo, "show", f"{commit}:{path}")


def contents_at(spark: SparkSession, repo: str, wanted: list[tuple[str, str]]) -> DataFrame:
    """``commit, filename, content`` of files at commits, read on the driver."""
    return spark.createDataFrame([(c, f, content_at(repo, c, f)) for c, f in wanted], "commit string, filename string, content string")


def machine(spark: SparkSession, models: str | None = None, name: str = "default") -> DataFrame:
    """The driver's processor, memory and model files as a hardware profile."""
    memory = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2**30
    found = sorted(str(p) for p in Path(models).glob("**/*.gguf")) if models and os.path.isdir(models) else []
    row = (name, platform.processor() or platform.machine(), round(memory, 1), None, json.dumps(found), "{}")
    return spark.createDataFrame([row], "profile_name string, cpu string, memory_gb double, gpu string, models string, benchmarks string")


def resources(spark: SparkSession, path: str = "/") -> DataFrame:
    """One row on the driver's use of memory, time and disk."""
    used, disk = resource.getrusage(resource.RUSAGE_SELF), shutil.disk_usage(path)
    return spark.createDataFrame([(used.ru_maxrss / 1024, used.ru_utime + used.ru_stime, disk.free / 2**30, disk.used / disk.total * 100)], "memory_mb double, cpu_seconds double, disk_free_gb double, disk_used_percent double")


def context_rows(spark: SparkSession, repo: str, status: dict[str, str] | None = None) -> DataFrame:
    """Rows of the project context: branch, commit, changed files, interpreter, and what else is known of the run."""
    changed = [x for x in _git(repo, "status", "--porcelain").splitlines() if x]
    known = {"git_branch": _git(repo, "rev-parse", "--abbrev-ref", "HEAD").strip(), "git_commit": head_hash(repo), "git_changed": str(len(changed)), "python": platform.python_version(), "platform": platform.system(), **(status or {})}
    return spark.createDataFrame([(k, v, True, n) for n, (k, v) in enumerate(known.items())], "context_key string, context_value string, active boolean, priority int")


def version_rows(spark: SparkSession, version: str, commit: str) -> dict[str, DataFrame]:
    """The version as a row of the environment and one of the context."""
    return {
        "environment_metadata": spark.createDataFrame([("version", version, commit)], "key string, value string, commit_hash string"),
        "project_context": spark.createDataFrame([("version", version, True, 0)], "context_key string, context_value string, active boolean, priority int"),
    }


def pattern_rows(spark: SparkSession, root: str) -> DataFrame:
    """Patterns that a project's files show: a package, a manifest, tests, a pipeline of checks."""
    shown = (("package", "*/__init__.py", "code is importable"), ("manifest", "pyproject.toml", "build and dependencies are declared"), ("tests", "tests/test_*.py", "behaviour is checked"), ("automation", ".github/workflows/*.y*ml", "checks run on every change"))
    rows = [(name, about, pattern) for name, pattern, about in shown if any(Path(root).glob(pattern))]
    return spark.createDataFrame(rows, "pattern_name string, solution_description string, code_examples string")


def session_row(spark: SparkSession, session: str, goals: list[str], actions: list[str]) -> DataFrame:
    return spark.createDataFrame([(session, "run", json.dumps(goals), json.dumps(actions), "[]", "{}")], "session_id string, agent_type string, goals string, actions string, outcomes string, metrics string")


def populate(spark: SparkSession, root: str, repo: str, version: str, session: str) -> list[str]:
    """Appends what is known of machine, project, version and session to the knowledge base; returns the tables written."""
    from .search import append_rows, create_tables

    create_tables(spark, root)
    now = F.current_timestamp().cast("string")
    rows = {"hardware_profiles": machine(spark), "architectural_patterns": pattern_rows(spark, repo), "agent_sessions": session_row(spark, session, [], []), **version_rows(spark, version, head_hash(repo))}
    rows["project_context"] = rows["project_context"].unionByName(context_rows(spark, repo))
    for name, df in rows.items():
        append_rows(df.withColumn("timestamp", now), root, name)
    return sorted(set(rows) & set(KNOWLEDGE))


def affected_functions(content: str | None) -> list[str]:
    """Names of the functions a source text defines, in order."""
    import re

    return re.findall(r"(?m)^\s*(?:pub\s+)?(?:async\s+)?(?:def|fn)\s+([0-9A-Za-z_]+)", content or "")


def breaking(old: str | None, new: str | None) -> list[str]:
    """Functions that the old text defines and the new one lacks."""
    return sorted(set(affected_functions(old)) - set(affected_functions(new)))


def enforce_hash(path: str, expected: str, override: bool = False) -> bool:
    """Does a file have the digest it must have? Another one is an error unless overridden."""
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 16):
            h.update(block)
    if h.hexdigest() == expected:
        return True
    if not override:
        raise RuntimeError(f"{path} does not have the expected digest")
    return False


def symbol(status: str, plain: bool | None = None) -> str:
    """A mark for a status; plain where the terminal's encoding has no others."""
    if plain is None:
        plain = "utf" not in (os.environ.get("PYTHONIOENCODING", "") + os.environ.get("LANG", "utf")).lower()
    return (PLAIN_SYMBOLS if plain else SYMBOLS).get(status, "?")


def logger(name: str = "brindle", level: str = "INFO", file: str | None = None, least_gb: float = 1.0) -> logging.Logger:
    """A logger to the terminal, and a file if given; warns where the disk is nearly full. Called again, it adds nothing."""
    log = logging.getLogger(name)
    log.setLevel(level)
    form = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
    for make, kind in ((lambda: logging.StreamHandler(), logging.StreamHandler), (lambda: logging.FileHandler(file), logging.FileHandler)):
        if (kind is logging.StreamHandler or file) and not any(type(h) is kind for h in log.handlers):
            handler = make()
            handler.setFormatter(form)
            log.addHandler(handler)
    if file and shutil.disk_usage(os.path.dirname(os.path.abspath(file))).free < least_gb * 1e9:
        log.warning("less than %s GB of disk left", least_gb)
    return log


@contextmanager
def session_scope(app: str = "brindle", **settings: str) -> Iterator[SparkSession]:
    """A session that is stopped at the end, however it comes."""
    from ..session import session

    spark = session(app, **settings)
    try:
        yield spark
    finally:
        spark.stop()
