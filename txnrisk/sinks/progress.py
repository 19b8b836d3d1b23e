"""What each consumer of a layer has read, so that nothing goes that is still to be read.

A note is an empty file, ``<consumer>/<generation>-<micro-batch>-<input batch>``: the input batch is the newest
one up to which the consumer has read everything with that micro-batch. No job is needed to write or read one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from txnrisk.sources.tables import NOTE, create_file, delete_folder, list_names, numbers


def _notes(spark: SparkSession, path: str, consumer: str) -> list[tuple[int, int, int]]:
    """(generation, micro-batch, input batch) of a consumer's notes."""
    names = [name.split("-") for name in list_names(spark, f"{path}/{consumer}")]
    return [tuple(map(int, parts)) for parts in names if len(parts) == 3 and all(p.isdigit() for p in parts)]


def record_progress(spark: SparkSession, path: str, consumer: str, micro_batch: int, up_to: int, generation: int = 0) -> None:
    """Note that with this micro-batch a consumer has read all input batches up to ``up_to``.

    The notes of the micro-batch before stay, as this one may not get committed; older ones go. Nothing
    is noted before the first input batch is read to its end.
    """
    if up_to < 0:
        return
    create_file(spark, f"{path}/{consumer}/{generation}-{micro_batch}-{up_to}")
    for note in _notes(spark, path, consumer):
        if note[0] < generation or note[1] < micro_batch - 1:
            delete_folder(spark, f"{path}/{consumer}/{'-'.join(map(str, note))}")


def committed_up_to(spark: SparkSession, path: str, consumer: str, checkpoint: str | None = None) -> int | None:
    """The newest input batch that a consumer will not read again, None if that isn't known.

    A micro-batch counts once its checkpoint has committed it; until then it may be repeated. A new
    checkpoint reads from the start, so only notes of its own generation count. Without a checkpoint the
    consumer's notes count as they are.
    """
    notes = _notes(spark, path, consumer)
    if checkpoint is not None:
        generations, commits = numbers(spark, checkpoint, NOTE), numbers(spark, f"{checkpoint}/commits", "")
        if not generations or not commits:
            return None
        notes = [n for n in notes if n[0] == max(generations) and n[1] <= max(commits)]
    return max((n[2] for n in notes), default=None)
