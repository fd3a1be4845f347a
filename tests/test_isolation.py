"""The library stands without the training-data subpackage: nothing outside it imports it but the guarded entry."""

import ast
import pathlib

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "corpusmill").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text(encoding="utf-8"))):
            if isinstance(node, ast.ImportFrom):
                assert "llm" not in (node.module or "").split(".") and all(a.name != "llm" for a in node.names), path
            elif isinstance(node, ast.Import):
                assert all("llm" not in a.name.split(".") for a in node.names), path
