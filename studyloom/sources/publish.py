"""Publishing files: bytes are copied by tasks, each file once, and stand under their name whole or not at all.

What becomes of a file is decided before any byte moves, by digests and names (``operators.files``). A task writes a file under a name
of its own in the staging folder, then gives it its target's name if nothing has that. So a task that is lost and repeated, or a run
that is repeated, finds what it has written by its digest and leaves it; nothing is ever replaced.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyloom.operators import files as P
from studyloom.sources.imaging_header import opened
from studyloom.storage import staged

PIECE = 1 << 20
STAGING = "_publishing"


def store_of(path: str):
    """The store of a path and its name there."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def digest_of(path: str) -> str:
    """Digest of a file's bytes, read in pieces; the empty string where there is no such file."""
    found = hashlib.sha256()
    try:
        with opened(path) as file:
            while piece := file.read(PIECE):
                found.update(piece)
    except FileNotFoundError:
        return ""
    return found.hexdigest()


def with_digests(files: DataFrame, path: str = "path") -> DataFrame:
    """files with sha, and the empty string where a file can't be found."""

    @F.pandas_udf("string")
    def digests(paths: pd.Series) -> pd.Series:
        return paths.map(digest_of)

    return files.withColumn("sha", digests(F.col(path)))


def put(source: str, root: str, target: str, sha: str) -> str:
    """Copies a file to a target below root that nothing has yet. written, or present where the target has these bytes already;
    source_changed where the source hasn't any more, conflict where the target has others: then nothing is left behind."""
    from pyarrow import fs

    store, base = store_of(root)
    final, temp = f"{base}/{target}", f"{base}/{STAGING}/{uuid.uuid4().hex}"
    if (there := digest_of(f"{root}/{target}")) != "":
        return "present" if there == sha else "conflict"
    found = hashlib.sha256()
    try:
        store.create_dir(f"{base}/{STAGING}", recursive=True)
        with opened(source) as file, store.open_output_stream(temp) as out:
            while piece := file.read(PIECE):
                found.update(piece)
                out.write(piece)
        if found.hexdigest() != sha:
            return "source_changed"
        store.create_dir(os.path.dirname(final), recursive=True)
        if isinstance(store, fs.LocalFileSystem):
            os.link(temp, final)  # fails where the name is taken, which a move does not
        elif store.get_file_info(final).type == fs.FileType.NotFound:
            store.move(temp, final)
        return "written" if digest_of(f"{root}/{target}") == sha else "conflict"
    except FileExistsError:
        return "present" if digest_of(f"{root}/{target}") == sha else "conflict"
    except FileNotFoundError:
        return "source_changed"
    finally:
        if store.get_file_info(temp).type != fs.FileType.NotFound:
            store.delete_file(temp)


def plan(files: DataFrame, root: str) -> DataFrame:
    """files(path, relative_path, target) with sha, status and final_target: as ``copy_status`` among themselves, and against what stands
    below root: the same bytes there are a duplicate, others a conflict, which goes beside them under its digest."""
    own = staged(P.copy_status(with_digests(files)), "publish-plan")
    there = own.select("target").distinct().withColumn("_path", F.concat(F.lit(root.rstrip("/") + "/"), "target"))
    there = staged(with_digests(there, "_path").select("target", F.col("sha").alias("_there")).where("_there <> ''"), "publish-there")
    d = own.join(there, "target", "left")
    beside = F.concat(F.regexp_replace("target", r"\.dcm$", "."), F.substring("sha", 1, 12), F.lit(".conflict.dcm"))
    taken, same = F.col("_there").isNotNull(), F.col("_there") == F.col("sha")
    status = F.when(F.col("sha") == "", "source_missing").when(taken & same, "duplicate_same").when(taken & (F.col("status") == "copied"), "conflict").otherwise(F.col("status"))
    final = F.when(taken & same, F.col("target")).when(taken, beside).otherwise(F.col("final_target"))
    return d.select(*files.columns, "sha", status.alias("status"), final.alias("final_target"))


def publish(planned: DataFrame, root: str, execute: bool = True) -> DataFrame:
    """A plan with outcome: what was done with each file. Files that are no duplicates are written, each by the one task that has it;
    without ``execute`` nothing is. The outcome is staged, so that reading it again copies nothing again."""
    writes = F.col("status").isin("copied", "conflict", "quarantined")
    if not execute:
        return planned.withColumn("outcome", F.when(writes, "planned").otherwise(F.col("status")))

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(outcome=[put(*row) for row in pdf[["path", "_root", "final_target", "sha"]].itertuples(index=False)]).drop(columns="_root")

    todo = planned.where(writes).withColumn("_root", F.lit(root.rstrip("/")))
    schema = planned.withColumn("outcome", F.lit("")).schema
    done = staged(todo.mapInPandas(copy, schema), "publish-outcome")
    return done.unionByName(planned.where(~writes).withColumn("outcome", F.col("status")))
