"""The engine stands without its optional parts."""

import ast
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent / "gleanery"


def test_nothing_outside_imports_the_optional_subpackage():
    for path in ROOT.rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text("utf-8"))):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path
