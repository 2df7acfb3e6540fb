"""Text expressions on random texts, against string handling in plain Python."""

import random
import re

from patchloom.functions import patches
from patchloom.functions import text as T
from patchloom.functions.rewards import format_reward
from tests.helpers import column

PIECES = [
    "```diff\n", "```", "```diff", "\n", "\n\n", "\r\n", "--- a/x", "+++ b/x", "diff --git a/x b/x", "-a", "+b",
    " ", "\t", "+import os", "+import numpy", "+from json import x", "+ import re, abc", "+MAX_1 = 2", "+ exec(",
    "+A==1", "+++ Z = 1", "-X = 1", "é", " ", "\x1c", "　", "text", "+", "import", "+__import__(", " ",
]


def texts(n=3000, seed=11):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        out.append("".join(rnd.choice(PIECES) + rnd.choice(["", "", "\n"]) for _ in range(rnd.randint(0, 12))))
    return out


def patch_in(text):
    start = text.find("```diff\n")
    stop = text.find("```", start + 8) if start >= 0 else -1
    if stop >= 0:
        return text[start + 8 : stop].strip()
    marks = [i + 1 for h in ("\n--- a/", "\ndiff --git") for i in [("\n" + text).find(h)] if i >= 0]
    return text[min(marks) - 1 :] if marks else None


def test_patches(spark):
    sample = texts()
    got = column(spark, sample, patches.extract_patch)
    want = [patch_in(t) for t in sample]
    assert got == want
    assert 200 < sum(w is None for w in want) < 2800 and "" in want


def test_rewards(spark):
    found = [p for p in map(patch_in, texts(seed=12)) if p is not None]

    def value(p):
        starts = {line[:1] for line in p.split("\n")}
        return 0.5 if {"-", "+"} <= starts and "---" in p and "+++" in p else 0.1

    assert column(spark, found, format_reward) == [value(p) for p in found]


def test_imports(spark):
    sample = texts(seed=13)
    listed = set(patches.ALLOWED_MODULES)
    assert len(listed) == 46
    added = re.compile(r"^\+\s*(?:import|from)\s+(\w+)", re.M)
    want = [all(m in listed for m in added.findall(t)) for t in sample]
    assert column(spark, sample, patches.imports_ok) == want
    assert 100 < sum(want) < 2990


def dropped(line):
    if line[:1] != "+" or line[:3] == "+++":
        return False
    body = line[1:].strip()
    name = body.split("=", 1)[0].rstrip() if "=" in body else ""
    constant = bool(name) and name[0] not in "0123456789" and set(name) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ_0123456789")
    return constant or any(body[: len(c)] == c for c in ("exec(", "eval(", "__import__"))


def test_stripped_lines(spark):
    sample = texts(seed=14)
    want = ["\n".join(x for x in t.split("\n") if not dropped(x)) for t in sample]
    assert column(spark, sample, patches.strip_global_lines) == want
    assert sum(w != t for w, t in zip(want, sample)) > 300


def test_caps_and_strip(spark):
    sample = texts(seed=15)
    assert column(spark, sample, T.strip) == [t.strip() for t in sample]
    cut = [t if len(t) <= 20 else t[:10] + "\n... [truncated] ...\n" + t[-10:] for t in sample]
    assert column(spark, sample, lambda c: T.truncate_middle(c, 20)) == cut
    capped = [t if len(t) <= 9 else t[:9] + "\n... [truncated]" for t in sample]
    assert column(spark, sample, lambda c: T.cap_text(c, 9)) == capped
