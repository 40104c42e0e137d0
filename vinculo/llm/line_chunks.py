"""Line dedup over content-defined chunks, with DataFrame functions only.

A rolling hash over two line hashes names every gap between neighbouring lines. A chunk ends at each gap whose name does not
stand at another place of the table: boundaries depend on the two lines around them and on nothing further up, so inserted or
missing lines shift nothing, and a passage is one chunk from its first line to its last, two lines or more, wherever it
stands. Lines of white space alone have no hash: the lines around them are neighbours, and what lies between goes with them.

Only names and places are shuffled to find the chunks; a frequent name is added up in each task before. The lines around
repeated names are then compared byte by byte, grouped by (name, bytes): a name of several texts is judged text by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculo.session import staged

SOLID = r"[^\x20\x09-\x0D]"  # a line with such a character is not blank
ROOM = 1 << 32  # places of a document


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _version(text: Column) -> Column:
    return F.when(text.isNotNull(), F.xxhash64(text))


def gaps(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (``id``, ``version``, ``k``, ``start``, ``stop``, ``name``) for every two neighbouring lines that are not blank.

    ``start`` and ``stop`` are 0-based lines, ``k`` counts from 0, ``version`` tells rows that share an id apart. Each step
    is a column of its own, so that it is computed once.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("id is not null and text is not null")
    hashed = F.transform(lines_of(F.col("text")), lambda line, i: F.when(line.rlike(SOLID), F.struct(i.alias("at"), F.xxhash64(line).alias("h"))))
    rows = rows.select("id", _version(F.col("text")).alias("version"), hashed.alias("hashed"))
    rows = rows.withColumn("solid", F.filter("hashed", lambda line: line.isNotNull())).drop("hashed").where("size(solid) > 1")
    follow = F.size("solid") - 1
    rolled = F.zip_with(
        F.slice("solid", 1, follow),
        F.slice("solid", 2, follow),
        lambda a, b: F.struct(a["at"].alias("start"), b["at"].alias("stop"), F.xxhash64(a["h"], b["h"]).alias("name")),
    )
    return rows.select("id", "version", F.posexplode(rolled).alias("k", "gap")).select("id", "version", "k", "gap.*")


def _place(id_: str = "id", k: str = "k") -> Column:
    return (F.col(id_).cast("decimal(20,0)") * F.lit(ROOM).cast("decimal(12,0)") + F.col(k)).cast("decimal(38,0)")


def _later(place: str, first: str) -> Column:
    """Whether two lines stand behind their first place, and not half upon it."""
    return F.col(place) > F.col(first) + 1


def marked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(``id``, ``version``, ``marks``): the gaps of a document whose name stands at several places; ``late`` where not first."""
    every = staged(gaps(docs, id_column, text_column), "gaps").withColumn("place", _place())
    often = every.groupBy("name").agg(F.min("place").alias("first"), F.max("place").alias("last")).where(_later("last", "first"))
    found = every.join(often.drop("last"), "name").withColumn("late", _later("place", "first"))
    return found.groupBy("id", "version").agg(F.collect_set(F.struct("k", "start", "stop", "name", "late")).alias("marks"))


def refuted(rows: DataFrame) -> DataFrame:
    """(``id``, ``version``, ``spared`` array of ``k``): late marks of ``rows`` whose own bytes do not stand earlier.

    ``rows`` has (``id``, ``version``, ``text``, ``marks``). Empty unless two different pairs of lines share a name.
    """
    spelt = rows.where("marks is not null").withColumn("lines", lines_of(F.col("text"))).select("id", "version", "lines", F.explode("marks").alias("m"))
    body = F.concat_ws("\n", F.get("lines", F.col("m.start")), F.get("lines", F.col("m.stop")))
    spelt = spelt.select("id", "version", "m.k", "m.name", "m.late", body.alias("body")).withColumn("place", _place())
    texts = spelt.groupBy("name", "body").agg(F.min("place").alias("first"))
    shared = staged(texts.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "collisions")
    doubtful = spelt.join(shared, "name", "left_semi")
    own = doubtful.groupBy("name", "body").agg(F.min("place").alias("first"))
    wrong = doubtful.where("late").join(own, ["name", "body"]).where(~_later("place", "first"))
    return wrong.groupBy("id", "version").agg(F.collect_set("k").alias("spared"))


def remove_repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the lines of repeated chunks, and with ``n_lines`` and ``n_removed`` (lines).

    Two neighbouring lines go if the same two stand at an earlier place, by (id, line); of lines that repeat within a
    document the first two stay whole. Blank lines between them go too. Lines end at line breaks alone. A text all of whose
    lines are repeated becomes empty; a document with one line that is not blank never changes; a null text stays null with
    no lines, an empty one has one empty line. Rows with a null id have no place in the order: they stay as they are, and
    nothing counts as a repetition of them. Rows that share an id share its places, so none of them repeats another line
    by line. Integer ids. All other columns pass, but for ones named ``n_lines`` or ``n_removed``, which are replaced.
    """
    own = {name: f"column {place}" for place, name in enumerate(docs.columns)}  # no clash with the names used here
    rows = docs.toDF(*own.values()).withColumns({"id": F.col(own[id_column]), "version": _version(F.col(own[text_column]))})
    rows = rows.join(marked(docs, id_column, text_column), ["id", "version"], "left").withColumnRenamed(own[text_column], "text")
    rows = staged(rows, "marked")
    rows = rows.join(staged(refuted(rows), "spared"), ["id", "version"], "left")
    late = F.filter("marks", lambda m: m["late"] & ~F.coalesce(F.array_contains("spared", m["k"]), F.lit(False)))
    rows = rows.withColumn("gone", F.flatten(F.transform(late, lambda m: F.sequence(m["start"], m["stop"]))))
    rows = rows.withColumn("changed", F.coalesce(F.size("gone") > 0, F.lit(False)))
    rows = rows.withColumn("lines", lines_of(F.col("text")))
    rows = rows.withColumn("stays", F.when(F.col("changed"), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))))
    kept = F.array_join(F.transform("stays", lambda i: F.get("lines", i)), "\n")
    text = F.when(F.col("changed"), kept).otherwise(F.col("text"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines"))
    removed = F.when(F.col("changed"), F.size("lines") - F.size("stays")).otherwise(0)
    added = {"n_lines": count, "n_removed": removed}
    columns = [text.alias(name) if name == text_column else F.col(own[name]).alias(name) for name in docs.columns if name not in added]
    return rows.select(*columns, *(value.cast("long").alias(name) for name, value in added.items()))
