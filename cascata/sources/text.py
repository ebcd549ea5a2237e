"""Directory line source.

Every line of every ``*.<extension>`` file under a directory (recursively),
each file read once: the streaming file source records the files it has
processed in the query's checkpoint, so a restarted query on the same
checkpoint does not read them again.  The extension filter is a
case-sensitive glob on the file name (``a.txt`` yes; ``b.TXT``, ``c.txt123``
no).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values that must equal the reference's for right results.
DEFAULT_EXTENSION = "txt"


def _reader(reader, extension: str):
    return (reader.format("text").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*.{extension}"))


def directory_lines(spark: SparkSession, directory: str, extension: str = DEFAULT_EXTENSION,
                    max_files_per_trigger: int | None = None, clean_source: str | None = None,
                    archive_dir: str | None = None) -> DataFrame:
    """Streaming ``line`` rows from the text files under ``directory``.

    ``clean_source`` may be ``archive`` (with ``archive_dir``) or ``delete``
    to move processed files away, best effort, as Spark documents it.
    """
    reader = _reader(spark.readStream.schema("value string"), extension)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(directory).withColumnRenamed("value", "line")


def read_directory_lines(spark: SparkSession, directory: str, extension: str = DEFAULT_EXTENSION) -> DataFrame:
    """Batch twin of ``directory_lines``."""
    return _reader(spark.read, extension).load(directory).withColumnRenamed("value", "line")
