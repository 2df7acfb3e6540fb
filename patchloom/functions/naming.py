"""Names built from a repository's owner, name and commit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name layout of the task images and of mirror commits.
IMAGE_PREFIX = "swesmith.x86_64"
COMMIT_CHARS = 8
REPO_FIELD = r"^([^/]+)/(.+?)__(.+)\.([^.]+)$"


def task_keys(owner: Column, repo: Column, commit: Column) -> dict[str, Column]:
    """Columns repo_key, mirror_name and image_name."""
    key = F.concat(owner, F.lit("__"), repo)
    return {
        "repo_key": key,
        "mirror_name": F.concat(owner, F.lit("/"), key, F.lit("."), F.left(commit, F.lit(COMMIT_CHARS))),
        "image_name": F.concat(F.lit(IMAGE_PREFIX + "."), key, F.lit("."), commit),
    }


def parse_repo(repo_field: Column) -> dict[str, Column]:
    """Split ``owner/owner__repo.commit``; null where the field has another form."""
    hit = repo_field.rlike(REPO_FIELD)

    def part(group: int) -> Column:
        return F.when(hit, F.regexp_extract(repo_field, REPO_FIELD, group))

    return {"owner": part(1), "repo_name": part(3), "commit": part(4)}
