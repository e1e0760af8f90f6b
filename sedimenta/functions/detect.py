"""The programming language of a snippet, by patterns on its first 2000 characters."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.text import let

# Patterns of each language, in the order that decides ties.
DETECTORS = (
    ("Python", (r"\bdef\b", r"\bimport\b", r"\bclass\b.*:", r"if __name__")),
    ("JavaScript", (r"\bfunction\b", r"\bconst\b", r"\blet\b", r"=>")),
    ("TypeScript", (r"\binterface\b", r": string\b", r": number\b", r"\btype\b.*=")),
    ("Java", (r"\bpublic\s+class\b", r"\bSystem\.out", r"@Override")),
    ("C/C++", (r"#include\s*[<\"]", r"\bstd::", r"\bvoid\b.*\(.*\)\s*\{")),
    ("Rust", (r"\bfn\b", r"\blet\s+mut\b", r"\bimpl\b", r"->.*Result")),
    ("Go", (r"\bfunc\b", r"\bpackage\b", r"\bfmt\.Print")),
    ("SQL", (r"\bSELECT\b", r"\bFROM\b", r"\bWHERE\b", r"\bJOIN\b")),
    ("Shell/Bash", (r"#!/bin/(ba)?sh", r"\becho\b", r"\$\{.*\}")),
    ("Ruby", (r"\bdef\b.*\bend\b", r"\bputs\b", r"\brequire\b")),
    ("PHP", (r"<\?php", r"\$\w+\s*=", r"\becho\b")),
)


def literal(pattern: str) -> str:
    """The longest text that every match of the pattern holds: what is left between its classes, groups and repeats."""
    plain = re.sub(r"\((?:\?:)?[^)]*\)\??|\[[^\]]*\]|\\[bsw][*+?]?|\.\*|\\[^.{}$(]|.[*+?]", "\0", pattern).replace("\\", "")
    return max(plain.split("\0"), key=len)


def detect_language(text: Column) -> Column:
    """The language with the most patterns found, the first of equals; ``Unknown`` for none or null."""

    def best(head: Column, flags: str) -> Column:
        hits = [reduce(lambda a, b: a + b, (F.coalesce(head.contains(literal(p)) & head.rlike(flags + p), F.lit(False)).cast("int") for p in patterns)) for _, patterns in DETECTORS]
        return F.array_max(F.array(*(F.struct(n.alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name")) for i, ((name, _), n) in enumerate(zip(DETECTORS, hits)))))

    # a search for a literal is fast and mostly fails, so few patterns are tried; Unicode classes are slow, and within ASCII the plain ones say the same
    found = let(F.substring(text, 1, 2000), lambda head: F.when(F.octet_length(head) == F.length(head), best(head, "(?d)")).otherwise(best(head, "(?Ud)")))
    return F.when(found["score"] > 0, found["name"]).otherwise(F.lit("Unknown"))
