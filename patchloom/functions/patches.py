"""Reading patches out of model output and looking inside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patchloom.functions.text import strip

# The shapes of a patch in model output. (?d) makes "\n" the only line
# end; (?U) with SPACE makes white space and word characters those of Python.
FENCED_PATCH = r"(?s)```diff\n(.*?)```"
BARE_PATCH = r"(?smd)^(?:--- a/|diff --git).*"
SPACE = r"[\s\x1c-\x1f]"
ADDED_IMPORT = rf"(?mdU)^\+{SPACE}*(?:import|from){SPACE}+(\w+)"
GLOBAL_LINE = rf"(?U)^\+(?!\+\+){SPACE}*(?:[A-Z_][A-Z_0-9]*{SPACE}*=|exec\(|eval\(|__import__)"

# Fixed value: the first modules an import may name without penalty.
ALLOWED_MODULES = (
    "os sys re json pathlib collections itertools functools typing dataclasses abc io "
    "math copy datetime time hashlib base64 urllib http logging unittest textwrap string "
    "enum contextlib operator shutil tempfile glob fnmatch struct csv configparser "
    "argparse subprocess threading multiprocessing socket warnings traceback inspect ast "
    "dis pdb profile"
).split()


def patch_files(patch: Column) -> Column:
    """Files named by the ``diff --git`` lines, in order, repeats kept."""
    headers = F.filter(F.split(patch, "\n"), lambda line: line.startswith("diff --git"))
    return F.transform(headers, lambda line: F.substring_index(line, " b/", -1))


def extract_patch(completion: Column) -> Column:
    """The patch in a completion, or null.

    A closed diff fence wins (an empty one gives ""); otherwise everything from the
    first bare diff header to the end. ``get(..., 0)`` keeps "no match" (null) apart
    from "matched nothing" ("") in a single pass over the text.
    """
    fenced = F.get(F.regexp_extract_all(completion, F.lit(FENCED_PATCH), F.lit(1)), F.lit(0))
    bare = F.get(F.regexp_extract_all(completion, F.lit(BARE_PATCH), F.lit(0)), F.lit(0))
    return F.coalesce(strip(fenced), bare)


def imports_ok(patch: Column) -> Column:
    """True when every added import line starts with an allowed module."""
    modules = F.regexp_extract_all(patch, F.lit(ADDED_IMPORT), F.lit(1))
    return F.forall(modules, lambda m: m.isin(ALLOWED_MODULES))


def strip_global_lines(patch: Column) -> Column:
    """Drop added lines that assign a global constant or run dynamic code."""
    kept = F.filter(F.split(patch, "\n"), lambda line: ~line.rlike(GLOBAL_LINE))
    return F.array_join(kept, "\n")
