import subprocess

import pytest

from brindle.operators import search, state


@pytest.fixture
def repo(tmp_path):
    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=x", "-c", "user.email=x@example.org", *a], check=True, capture_output=True)
    run("init", "-q")
    (tmp_path / "a.rs").write_text("fn one() {}\n")
    run("add", ".")
    run("commit", "-qm", "first")
    (tmp_path / "a.rs").write_text("fn two() {}\n")
    (tmp_path / "pyproject.toml").write_text("")
    return tmp_path


def test_repository(spark, repo):
    head = state.head_hash(str(repo))
    assert len(head) == 40 and state.head_hash(str(repo), "a.rs") == head and state.head_hash("/nowhere") == ""
    assert state.content_at(str(repo), head, "a.rs") == "fn one() {}\n" and state.content_at(str(repo), head, "b.rs") is None
    assert [tuple(r)[1:] for r in state.contents_at(spark, str(repo), [(head, "a.rs"), (head, "none")]).collect()] == [("a.rs", "fn one() {}\n"), ("none", None)]
    found = {r.context_key: r.context_value for r in state.context_rows(spark, str(repo), {"stage": "test"}).collect()}
    assert found["git_commit"] == head and found["git_changed"] == "2" and found["stage"] == "test"
    assert [r.pattern_name for r in state.pattern_rows(spark, str(repo)).collect()] == ["manifest"]


def test_populated_tables(spark, repo, tmp_path_factory):
    root = "file://" + str(tmp_path_factory.mktemp("kb"))
    assert state.populate(spark, root, str(repo), "1.2.3", "s1") == ["agent_sessions", "architectural_patterns", "environment_metadata", "hardware_profiles", "project_context"]
    assert search.table(spark, root, "environment_metadata").first().value == "1.2.3"
    assert search.system_profile(search.table(spark, root, "hardware_profiles")).first().hardware.memory_gb > 0


def test_guards(tmp_path):
    assert state.rate_limit({"resources": {"core": {"remaining": 99}}}) == (99, True) and state.rate_limit({"resources": {"core": {"remaining": 100}}}) == (100, False) and state.rate_limit({}) == (0, True)
    assert state.token_problem(None) and state.token_problem("a b" * 9) and state.token_problem("short") and state.token_problem("x" * 40) is None
    (tmp_path / "f").write_text("text")
    good = "982d9e3eb996f559e633f4d194def3761d909f5a3b647d1a851fead67c32c9d1"
    assert state.enforce_hash(str(tmp_path / "f"), good) and not state.enforce_hash(str(tmp_path / "f"), "0", override=True)
    with pytest.raises(RuntimeError):
        state.enforce_hash(str(tmp_path / "f"), "0")
    assert state.affected_functions("pub fn a() {}\n  async def b(x):\n") == ["a", "b"] and state.breaking("fn a()\nfn b()", "fn b()") == ["a"]
    assert state.symbol("PASS", plain=True) == "[OK]" and state.symbol("PASS", plain=False) == "✅" and state.symbol("none") == "?"


def test_driver_rows(spark, tmp_path):
    assert state.resources(spark).first().memory_mb > 0
    for _ in range(2):
        log = state.logger("brindle-test", file=str(tmp_path / "log"))
    log.info("said once")
    assert len(log.handlers) == 2 and (tmp_path / "log").read_text().count("said once") == 1
