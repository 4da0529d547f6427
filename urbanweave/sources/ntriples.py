"""Triples as N-Triples lines.

A triple has columns ``s, p, o, o_kind`` and, where terms need them, ``language`` and ``datatype``. ``o_kind`` is ``iri``, ``blank`` or
``literal``; a subject or object that starts with ``_:`` is a blank node's label. What is written is read back term by term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TERM = r"(?:<([^>]*)>|(_:[^\s<>]+))"
_LINE = (r"^\s*" + _TERM + r"\s+<([^>]*)>\s+(?:" + _TERM + r'|"((?:[^"\\]|\\.)*)"(?:@([\w-]+)|\^\^<([^>]*)>)?)\s*\.\s*(?:#.*)?$')
#: Stands for an escaped backslash while the other escapes are undone; cannot occur in the text.
_HELD = "\u0000"


def _escaped(text: Column) -> Column:
    for raw, mark in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def _plain(text: Column) -> Column:
    text = F.replace(text, F.lit("\\\\"), F.lit(_HELD))
    for mark, raw in (('\\"', '"'), ("\\'", "'"), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\b", "\b"), ("\\f", "\f")):
        text = F.replace(text, F.lit(mark), F.lit(raw))
    text = _decoded(_decoded(text, "u", 4), "U", 8)
    return F.replace(text, F.lit(_HELD), F.lit("\\"))


def _decoded(text: Column, mark: str, width: int) -> Column:
    """Characters given by their number in ``width`` hexadecimal digits after a backslash and ``mark``."""
    pieces = F.split(text, F.lit(r"\\" + mark + r"(?=[0-9A-Fa-f]{" + str(width) + "})"))
    letter = lambda piece: F.decode(F.unhex(F.lpad(F.substring(piece, 1, width), 8, "0")), "UTF-32")
    whole = F.array_join(F.transform(pieces, lambda piece, k: F.when(k == 0, piece).otherwise(
        F.concat(letter(piece), F.substring(piece, width + 1, 1 << 30)))), "")
    return F.when(F.contains(text, F.lit("\\" + mark)), whole).otherwise(text)


#: Characters that stand in an IRI of a line only by their number.
_NOT_IN_IRI = r"[\x00-\x20<>\"{}|^`\\]"


def _iri(text: Column) -> Column:
    marked = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(
        c.rlike(_NOT_IN_IRI), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(c).cast("long")), 4, "0"))).otherwise(c)), "")
    return F.concat(F.lit("<"), F.when(text.rlike(_NOT_IN_IRI), marked).otherwise(text), F.lit(">"))


def _node(text: Column) -> Column:
    """A subject or object that isn't a literal."""
    return F.when(F.startswith(text, F.lit("_:")), text).otherwise(_iri(text))


def ntriples_lines(triples: DataFrame, entity_quotes: bool = False) -> DataFrame:
    """One line per triple in column ``value``. ``entity_quotes`` writes double and single quotes in literals
    as ``&apos;``, the form the graph loader was fed with."""
    text = F.col("o")
    if entity_quotes:
        text = F.regexp_replace(text, "[\"']", "&apos;")
    literal = F.concat(F.lit('"'), _escaped(text), F.lit('"'))
    if "datatype" in triples.columns:
        literal = F.when(F.col("datatype").isNotNull(), F.concat(literal, F.lit("^^"), _iri(F.col("datatype")))).otherwise(literal)
    if "language" in triples.columns:
        literal = F.when(F.col("language").isNotNull(), F.concat(literal, F.lit("@"), F.col("language"))).otherwise(literal)
    return triples.select(F.concat(
        _node(F.col("s")), F.lit(" "), _iri(F.col("p")), F.lit(" "),
        F.when(F.col("o_kind") == "literal", literal).when(F.col("o_kind") == "iri", _iri(F.col("o"))).otherwise(_node(F.col("o"))), F.lit(" ."),
    ).alias("value"))


def write_ntriples(triples: DataFrame, path: str, entity_quotes: bool = False) -> str:
    ntriples_lines(triples, entity_quotes).write.mode("errorifexists").text(path)
    return path


def read_ntriples(spark: SparkSession, path: str, details: bool = False) -> DataFrame:
    """Triples of all N-Triples lines below ``path``; comments and blank lines are skipped, bad lines fail.

    ``o_kind`` is ``iri``, ``blank`` or ``literal``. With ``details`` the ``language`` and the ``datatype`` of literals are columns too.
    Escaped characters of literals and IRIs are decoded. A blank node's label holds in its own file only, so it gets a prefix by the
    file; the parts that Spark wrote into one folder are one file.
    """
    lines = spark.read.text(path).select("value", F.regexp_replace("_metadata.file_path", r"/part-[^/]*$", "").alias("file"))
    lines = lines.where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    part = lambda k: F.nullif(F.regexp_extract("value", _LINE, k), F.lit(""))
    label = lambda k: F.concat(F.lit("_:f"), F.lower(F.hex(F.xxhash64("file"))), F.lit("-"), F.substr(part(k), F.lit(3)))
    iri = lambda k: _decoded(_decoded(part(k), "u", 4), "U", 8)
    good = F.when(F.col("value").rlike(_LINE), F.coalesce(iri(1), label(2))).otherwise(
        F.raise_error(F.concat(F.lit("not an N-Triples line: "), F.col("value")))
    )
    kind = F.when(part(4).isNotNull(), "iri").when(part(5).isNotNull(), "blank").otherwise("literal")
    text = _plain(F.regexp_extract("value", _LINE, 6))
    return lines.select(
        good.alias("s"), iri(3).alias("p"), F.coalesce(iri(4), label(5), text).alias("o"), kind.alias("o_kind"),
        *([part(7).alias("language"), iri(8).alias("datatype")] if details else []),
    )
