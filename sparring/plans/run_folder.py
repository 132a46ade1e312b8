"""The folder of one run: what is finished there is read again, so that a restarted driver goes on where it stopped."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparring.session import delete_path, path_exists

SETTINGS = "settings"


class RunFolder:
    """Named steps below one path. A step counts as done once its mark, written after everything else of it, is there."""

    def __init__(self, spark: SparkSession, path: str, settings: Mapping):
        """Open or begin a run; a folder that was begun with other settings is an error."""
        self.spark, self.path = spark, path.rstrip("/")
        known = self.note(SETTINGS)
        wanted = json.loads(json.dumps(settings, default=str, sort_keys=True))
        if known is None:
            self.put_note(SETTINGS, wanted)
        elif known != wanted:
            differing = sorted(k for k in {*known, *wanted} if known.get(k) != wanted.get(k))
            raise ValueError(f"{path} belongs to a run with other {differing}")

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def note(self, name: str) -> dict | None:
        """What was noted under a name, None if nothing was."""
        where = self.at(f"{name}.note")
        if not path_exists(self.spark, f"{where}/_SUCCESS"):
            return None
        return json.loads(self.spark.read.text(where, wholetext=True).first()[0])

    def put_note(self, name: str, content: Mapping) -> None:
        """Note something; with it a step is done."""
        where, text = self.at(f"{name}.note"), json.dumps(content, default=str, sort_keys=True)
        self.spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(where)

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step, made and written unless an earlier attempt has written it whole."""
        if not path_exists(self.spark, self.at(f"{name}/_SUCCESS")):
            delete_path(self.spark, self.at(name))  # what a stopped attempt left
            make().write.parquet(self.at(name))
        return self.spark.read.parquet(self.at(name))

    def step(self, name: str, make: Callable[[str], Mapping]) -> dict:
        """The note of a step that writes below its own path by itself; `make` gets that path, empty."""
        done = self.note(name)
        if done is None:
            delete_path(self.spark, self.at(name))
            self.put_note(name, make(self.at(name)))
            done = self.note(name)
        return done

    def release(self) -> None:
        """Delete everything of the run; its tables cannot be read afterwards."""
        delete_path(self.spark, self.path)
