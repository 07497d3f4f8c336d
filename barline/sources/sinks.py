"""Writers for labels and scores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.session import open_fs

# Fixed value: the time format of label files.
ISO_ZULU = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def write_targets_csv(targets: DataFrame, path: str, keys: tuple[str, ...] = ()) -> None:
    """Label rows as CSV, sorted by time (a range shuffle, no single writer)."""
    (targets.orderBy("timestamp", *keys).write.mode("overwrite")
     .option("header", "true").option("timestampNTZFormat", ISO_ZULU).csv(path))


def prediction_columns(scored: DataFrame, id_column: str | None = None, merge_input: bool = False) -> DataFrame:
    """Scores in output order: the id first, then ``y_pred``, then the inputs."""
    first = [F.col(f"`{id_column}`")] if id_column and id_column in scored.columns else []
    rest = [F.col(f"`{c}`") for c in scored.columns
            if merge_input and c != "y_pred" and not (first and c == id_column)]
    return scored.select(*first, "y_pred", *rest)


def write_predictions_csv(scored: DataFrame, path: str, id_column: str | None = None,
                          merge_input: bool = False) -> None:
    (prediction_columns(scored, id_column, merge_input).write.mode("overwrite")
     .option("header", "true").csv(path))


def write_files(files: DataFrame, root: str) -> None:
    """Rows ``folder, name, content`` as a file each, ``root/folder/name``; each name
    once, NULL content as an empty file.

    The tasks write them, so that files cost the driver nothing. A file gets its
    name when it is whole; a task that runs again writes the same files.
    """
    def write(rows) -> None:
        store, base = open_fs(root)
        last = None
        for folder, name, content in rows:
            if folder != last:
                store.create_dir(f"{base}/{folder}", recursive=True)
                last = folder
            part = f"{base}/{folder}/.{uuid.uuid4().hex}"
            with store.open_output_stream(part, compression=None) as out:
                out.write((content or "").encode())
            store.move(part, f"{base}/{folder}/{name}")

    files.select("folder", "name", "content").foreachPartition(write)
