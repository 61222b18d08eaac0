"""Listings of a folder hierarchy: ``id, name, mimeType, parents array<string>[, trashed]``.

Only folders are walked level by level. Files, the bulk of a listing, meet their folder in a
single equi-join, where adaptive execution splits a folder that holds most of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formtide.functions.fixed_values import FOLDER_MIME
from formtide.functions.paths import entry_kind


def _live(entries: DataFrame) -> DataFrame:
    if "trashed" in entries.columns:
        return entries.filter(~F.coalesce(F.col("trashed"), F.lit(False)))
    return entries


def list_children(entries: DataFrame, folder: str) -> DataFrame:
    """Direct children of a folder with their kind, trashed ones left out."""
    inside = F.array_contains("parents", F.lit(folder))
    return _live(entries).filter(inside).withColumn("type", entry_kind("mimeType"))


def folder_paths(entries: DataFrame, root: str) -> DataFrame:
    """Every folder below a root: ``folder_id, path``; the root itself has an empty path.

    A folder reached over two parents has two paths. A folder inside itself is not followed.
    """
    folders = (
        _live(entries)
        .filter(F.col("mimeType") == FOLDER_MIME)
        .select("id", "name", F.explode("parents").alias("parent"))
    )
    return entries.sparkSession.sql(
        """
        WITH RECURSIVE walk(folder_id, path, trail) AS (
            SELECT :root, '', array(:root)
            UNION ALL
            SELECT f.id,
                   CASE WHEN w.path = '' THEN f.name ELSE concat(w.path, '/', f.name) END,
                   array_append(w.trail, f.id)
            FROM walk w JOIN {folders} f ON f.parent = w.folder_id
            WHERE NOT array_contains(w.trail, f.id)
        )
        SELECT folder_id, path FROM walk
        """,
        args={"root": root},
        folders=folders,
    )


def _files(entries: DataFrame) -> DataFrame:
    return (
        _live(entries)
        .filter(~F.col("mimeType").eqNullSafe(FOLDER_MIME))
        .select("id", "name", "mimeType", F.explode("parents").alias("folder_id"))
    )


def list_files_deep(entries: DataFrame, root: str) -> DataFrame:
    """All files below a folder at any depth, with the path of their folder."""
    return _files(entries).join(folder_paths(entries, root), "folder_id")


def list_tree(entries: DataFrame, root: str) -> DataFrame:
    """The hierarchy in rows: every folder with each of its files, empty folders too.

    One row per folder and file, so no folder is gathered into one value. A folder without files
    enters the files as one row without a file; all of them then meet the one walk in an inner join,
    whose skewed side adaptive execution can split, where an outer join would pin a folder that holds
    most files to one task.
    """
    files = _files(entries).select(
        "folder_id",
        F.col("id").alias("file_id"),
        F.col("name").alias("file_name"),
        "mimeType",
    )
    folders = _live(entries).filter(F.col("mimeType") == FOLDER_MIME).select(F.col("id").alias("folder_id"))
    folders = folders.unionByName(entries.sparkSession.range(1).select(F.lit(root).alias("folder_id")))
    empty = folders.distinct().join(files.select("folder_id").distinct(), "folder_id", "left_anti")
    content = files.unionByName(empty, allowMissingColumns=True)
    columns = ["folder_id", "path", "file_id", "file_name", "mimeType"]
    return content.join(folder_paths(entries, root), "folder_id").select(*columns)


def resolve_path(entries: DataFrame, root: str, path: str) -> DataFrame:
    """The folder that a path names below a root: one row ``id``, or none.

    Every level must match exactly one folder.
    """
    if not root or not path:
        raise ValueError("root and path are required")
    if path.startswith("/") or path.endswith("/"):
        raise ValueError("the path starts and ends with a name, not with /")
    folders = entries.filter(F.col("mimeType") == FOLDER_MIME)
    here = entries.sparkSession.createDataFrame([(root,)], "id string")
    for name in path.split("/"):
        if not name:
            break
        candidates = folders.filter(F.col("name") == name).select(
            F.col("id").alias("_child"), F.explode("parents").alias("_parent")
        )
        here = (
            candidates.join(here, F.col("_parent") == F.col("id"))
            .agg(F.count(F.lit(1)).alias("_matches"), F.first("_child").alias("_found"))
            .filter(F.col("_matches") == 1)
            .select(F.col("_found").alias("id"))
        )
    return here
