"""Static checks: no row-at-a-time Python, no RDDs, nothing of the optional subpackage elsewhere."""

import ast
from pathlib import Path

import pytest

PACKAGE = Path(__file__).resolve().parents[1] / "noticeworks"
FILES = sorted(p for p in PACKAGE.rglob("*.py") if "llm" not in p.parts)


@pytest.mark.parametrize("path", FILES, ids=lambda p: str(p.relative_to(PACKAGE)))
def test_file(path):
    tree = ast.parse(path.read_text())
    for node in ast.walk(tree):
        if isinstance(node, ast.Attribute):
            assert node.attr not in {"udf", "rdd", "toLocalIterator", "toPandas", "foreach", "localCheckpoint", "iterrows"}, f"{path}:{node.lineno}"
        if isinstance(node, ast.ImportFrom | ast.Import):
            assert "llm" not in ast.unparse(node), f"{path}:{node.lineno}"


@pytest.mark.parametrize("path", [p for p in FILES if p.parent.name == "functions"], ids=lambda p: p.name)
def test_functions_start_no_jobs(path):
    calls = {n.func.attr for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.Call) and isinstance(n.func, ast.Attribute)}
    assert not calls & {"collect", "count_rows", "first", "head", "take", "show"}
