"""Programming language of texts and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import SPACE, WORD, strip

# Spellings of languages.
ALIASES = {
    "py": "python", "python3": "python", "js": "javascript", "jsx": "javascript", "ts": "typescript", "tsx": "typescript",
    "c++": "cpp", "cc": "cpp", "cxx": "cpp", "bash": "shell", "sh": "shell",
}
# File suffixes of each language.
SUFFIXES = {
    "python": [".py"], "javascript": [".js", ".jsx", ".mjs", ".cjs"], "typescript": [".ts", ".tsx"], "java": [".java"],
    "cpp": [".cc", ".cpp", ".cxx", ".h", ".hpp"], "go": [".go"], "rust": [".rs"], "shell": [".sh"], "sql": [".sql"],
}
# What a text of each language holds, in the order they are tried; any case, over lines.
SIGNS = [
    ("python", rf"\bdef\s+{WORD}+\s*\(|\bimport\s+{WORD}+|\bfrom\s+{WORD}+\s+import\b"),
    ("typescript", rf"\binterface\s+{WORD}+|:\s*(?:string|number|boolean)\b"),
    ("javascript", rf"\b(?:const|let|var)\s+{WORD}+|=>"),
    ("java", r"\bpublic\s+(?:static\s+)?(?:class|void|int|String)\b"),
    ("cpp", r"#include\s*[<\"]|\bstd::"),
    ("go", rf"\bpackage\s+main\b|\bfunc\s+{WORD}+\s*\("),
    ("rust", rf"\bfn\s+{WORD}+\s*\(|\blet\s+mut\b"),
    ("shell", r"^#!.*\b(?:bash|sh)\b"),
    ("sql", r"\bSELECT\b.+\bFROM\b"),
]
# Fixed value: the label of a fenced block.
FENCE_LABEL = r"```\s*([A-Za-z0-9_+.#-]+)"


def _alias(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, c), c)


def infer_language(text: Column, fallback: Column | None = None) -> Column:
    """Label of the first fence, else the first language whose signs occur, else the fallback.

    An unlabelled fence takes the first word of its code as label, as ``\\s*`` crosses the line end.
    """
    label = F.regexp_extract(text, FENCE_LABEL, 1)
    out = F.when(label != "", _alias(F.lower(label)))
    for name, pattern in SIGNS:
        out = out.when(text.rlike(f"(?dims){pattern}"), name)
    return out.otherwise(_alias(F.lower(strip(F.lit("unknown") if fallback is None else fallback))))


def path_language(path: Column) -> Column:
    """Language by the suffix of the file name; a name that only begins with a dot has none."""
    name = F.regexp_extract(path, r"([^/]*)/*\z", 1)
    suffix = F.lower(F.regexp_extract(name, r"\A.+(\.[^.]+)\z", 1))
    out = None
    for language, suffixes in SUFFIXES.items():
        out = (F if out is None else out).when(suffix.isin(suffixes), language)
    return out.otherwise("unknown")
