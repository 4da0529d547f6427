"""Declarative mappings from records to triples.

A mapping is the usual nested dictionary: ``prefixes`` and ``mappings``; each entry has ``sources``
(``[file~jsonpath, path]``), a subject template ``s`` and predicate-object pairs ``po``. All entries on one
source are expanded from a single projection, so each source is scanned once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanweave.operators.graph import RDF_TYPE
from urbanweave.operators.reshape import name, quoted
from urbanweave.session import settle

_REFERENCE = re.compile(r"\$\(([^)]*)\)")
_SOURCE = re.compile(r"^\$\.(?P<name>[\w.]+)\[\*\](?:\[(?P<root>\w+)\])?$")


@dataclass(frozen=True)
class Rule:
    """One kind of triple made per record: templates with prefixes already expanded."""

    source: str
    root: str | None
    subject: str
    predicate: str
    object: str
    kind: str


def expand_prefixes(term: str, prefixes: dict[str, str]) -> str | None:
    """IRI of ``prefix:name``, the type predicate for ``a``, or None for text without a known prefix."""
    if term == "a":
        return RDF_TYPE
    prefix, colon, name = term.partition(":")
    return prefixes[prefix] + name if colon and prefix in prefixes else None


def mapping_rules(mapping: dict, canonical_prefixes: dict[str, str] | None = None) -> list[Rule]:
    """Rules of a mapping document. ``canonical_prefixes`` override the spellings of the document."""
    prefixes = {**mapping["prefixes"], **(canonical_prefixes or {})}
    rules = []
    for entry in mapping["mappings"].values():
        subject = expand_prefixes(entry["s"], prefixes) or entry["s"]
        for _, path in entry["sources"]:
            found = _SOURCE.match(path)
            if not found:
                raise ValueError(f"source path {path!r}")
            for predicate, term in entry["po"]:
                iri = expand_prefixes(str(term), prefixes)
                rules.append(Rule(
                    found["name"], found["root"], subject, expand_prefixes(predicate, prefixes) or predicate,
                    iri or str(term), "iri" if iri else "literal",
                ))
    return rules


def _reference(df: DataFrame, root: str | None, reference: str) -> tuple[str, T.DataType]:
    """Column of ``$(name)`` in SQL and its type: a top-level name (even with dots), or a path into structs."""
    for whole in ([f"{root}.{reference}"] if root else []) + ([] if root else [reference]):
        if whole in df.columns:
            return name(whole), df.schema[whole].dataType
    path = ([root] if root else []) + ([reference] if root else reference.split("."))
    kind = df.schema
    for depth, step in enumerate(path):
        if not isinstance(kind, T.StructType) or step not in kind.names:
            rest = ".".join(path[depth:])
            raise KeyError(f"no column for $({reference}): {rest!r} is missing in {root or 'the record'}")
        kind = kind[step].dataType
    return ".".join(name(step) for step in path), kind


def literal(text: str) -> str:
    """Text in SQL."""
    for raw, mark in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = text.replace(raw, mark)
    return f"'{text}'"


def encode_iri(text: str) -> str:
    """SQL for the percent-encoding of all but unreserved characters, for text put in an IRI (blank is ``%20``)."""
    out = f"url_encode({text})"
    for raw, mark in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = f"replace({out}, '{raw}', '{mark}')"
    return out


# Characters that may not stand in an IRI.
NOT_IN_IRIS = "<>\"{}|\\^`"
_CONTROLS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
_NOT_IN_IRIS = r"[\x00-\x20<>\"{}|\\^`]"


def valid_iri(text: str) -> str:
    """SQL for the text with just the characters encoded that no IRI may hold; whole IRIs and paths keep their meaning."""
    out = f"regexp_replace({text}, {literal(_CONTROLS)}, '')"
    for raw in " \t\n\r" + NOT_IN_IRIS:
        out = f"replace({out}, {literal(raw)}, '%{ord(raw):02X}')"
    return f"if({text} rlike {literal(_NOT_IN_IRIS)}, {out}, {text})"


def coded(text: str, encode: bool | None) -> str:
    """Text as it goes into an IRI. ``encode``: True for :func:`encode_iri`, None for :func:`valid_iri`, False for the text as it is."""
    return text if encode is False else encode_iri(text) if encode else valid_iri(text)


def fill_template(df: DataFrame, root: str | None, template: str, encode: bool | None = False,
                  ready: dict[tuple[str | None, str], str] | None = None) -> tuple[str, bool]:
    """SQL for the text of a template, and whether it is a list (one value per element of an array column).

    A null in any referenced column makes the value null. ``encode`` is that of :func:`coded`, for the references; those in ``ready`` have
    columns that are coded already.
    """
    pieces, last, listed = [], 0, None
    for found in _REFERENCE.finditer(template):
        if found.start() > last:
            pieces.append(literal(template[last:found.start()]))
        column, kind = _reference(df, root, found.group(1))
        if isinstance(kind, T.ArrayType):
            if listed is not None:
                raise ValueError(f"{template!r} refers to two lists")
            listed = column
            pieces.append(coded("cast(item as string)", encode))
        elif ready and (root, found.group(1)) in ready:
            pieces.append(ready[root, found.group(1)])
        else:
            pieces.append(coded(f"cast({column} as string)", encode))
        last = found.end()
    if last < len(template) or not pieces:
        pieces.append(literal(template[last:]))
    text = f"concat({', '.join(pieces)})" if len(pieces) > 1 else pieces[0]
    return (text, False) if listed is None else (f"transform({listed}, item -> {text})", True)


def _iri_texts(df: DataFrame, rules: list[Rule], encode: bool | None) -> dict[tuple[str | None, str], str]:
    """Coded text of every single-valued reference that the IRIs of the rules have: made once a record, however many rules use it."""
    out = {}
    for rule in rules if encode is not False else ():
        for template in (rule.subject, rule.object) if rule.kind == "iri" else (rule.subject,):
            for reference in _REFERENCE.findall(template):
                column, kind = _reference(df, rule.root, reference)
                if not isinstance(kind, T.ArrayType):
                    text = f"cast({column} as string)"
                    out[rule.root, reference] = text if isinstance(kind, (T.IntegralType, T.DateType)) else coded(text, encode)
    return out


def _triples(df: DataFrame, rule: Rule, encode: bool | None, ready: dict[tuple[str | None, str], str]) -> str:
    """SQL for the array of the triples of one rule."""
    subject, listed = fill_template(df, rule.root, rule.subject, encode, ready)
    if listed:
        raise ValueError(f"subject {rule.subject!r} refers to a list")
    iri = rule.kind == "iri"
    value, many = fill_template(df, rule.root, rule.object, encode if iri else False, ready if iri else None)

    def triple(item: str) -> str:
        return f"named_struct('s', {subject}, 'p', {literal(rule.predicate)}, 'o', {item}, 'o_kind', '{rule.kind}')"

    return f"transform({value}, term -> {triple('term')})" if many else f"array({triple(value)})"


def _used_columns(df: DataFrame, rules: list[Rule]) -> list[str]:
    """Top-level columns the rules refer to."""
    used = set()
    for rule in rules:
        for template in (rule.subject, rule.object):
            for reference in _REFERENCE.findall(template):
                if rule.root and f"{rule.root}.{reference}" in df.columns:
                    used.add(f"{rule.root}.{reference}")
                else:
                    used.add(rule.root or (reference if reference in df.columns else reference.split(".")[0]))
    return [c for c in df.columns if c in used]


def _apart(one: Rule, other: Rule) -> bool:
    """Whether no records can make the rules state the same triple, as far as their constant texts tell."""
    if one.predicate != other.predicate or one.kind != other.kind:
        return True
    for a, b in ((one.subject, other.subject), (one.object, other.object)):
        x, y = _REFERENCE.split(a), _REFERENCE.split(b)  # constant texts at even places
        if len(x) == len(y) == 1 and a != b:
            return True
        heads, tails = (x[0], y[0]), (x[-1][::-1], y[-1][::-1])
        if any(not p.startswith(q) and not q.startswith(p) for p, q in (heads, tails)):
            return True
    return False


def _made_by(rule: Rule, key: str, digests: dict[str, Column]) -> str | None:
    """``'key'`` if a triple of the rule tells the record's key, ``'iri'`` if it tells the key's text in IRIs and holds nothing else of the
    record, None if it may tell neither."""
    sides = [[(kind, reference) for reference in _REFERENCE.findall(template)] for kind, template in (("iri", rule.subject), (rule.kind, rule.object))]
    told = {side[0] for side in sides if len(side) == 1}
    if any(reference in digests or (kind, reference) == ("literal", key) for kind, reference in told):
        return "key"
    return "iri" if told and {use for side in sides for use in side} == {("iri", key)} else None


def _keyed_triples(df: DataFrame, rules: list[Rule], key: str, digests: dict[str, Column], encode: bool | None) -> DataFrame | None:
    """Distinct triples of records that ``key`` tells apart, without a look at the triples: only keys are shuffled. None if the rules don't allow it.

    Keys of different text can have one text in IRIs. Such a text belongs to a key that is changed by the coding; these texts are found
    first, and what depends on them alone is stated for them once instead of for each key.
    """
    made_by = [_made_by(rule, key, digests) for rule in rules]
    if (any(rule.root for rule in rules) or None in made_by or not set(_used_columns(df.withColumns(digests), rules)) <= {key, *digests}
            or isinstance(df.schema[key].dataType, (T.ArrayType, T.StructType, T.MapType))
            or not all(_apart(a, b) for k, a in enumerate(rules) for b in rules[:k])):
        return None
    text = f"cast({name(key)} as string)"
    exact = isinstance(df.schema[key].dataType, (T.IntegralType, T.DateType)) or encode is False
    keys = df.selectExpr(f"{text} as {name(key)}").where(quoted(key).isNotNull())
    coded_keys = lambda frame: frame.withColumn("__iri", F.expr(name(key) if exact else coded(name(key), encode)))
    every = coded_keys(keys.distinct()).withColumns(digests)
    ready = {(None, key): "__iri", **{(None, c): name(c) for c in digests}}
    stated = {level: f"array({', '.join(_triples(every, rule, encode, ready) for rule, of in zip(rules, made_by) if of == level)})" for level in set(made_by)}
    shared = None if exact or "iri" not in stated else settle(coded_keys(keys).where(F.col("__iri") != quoted(key)).select("__iri").distinct())
    if shared is None or shared.isEmpty():
        return every.selectExpr(f"inline(flatten(concat({', '.join(stated.values())})))")
    parts = [every.join(shared, "__iri", "left_anti").selectExpr(f"inline(flatten({stated['iri']}))"), shared.selectExpr(f"inline(flatten({stated['iri']}))")]
    if "key" in stated:
        parts.append(every.selectExpr(f"inline(flatten({stated['key']}))"))
    return reduce(DataFrame.unionByName, parts)


def apply_mapping(frames: dict[str, DataFrame], mapping: dict, encode: bool | None = None,
                  canonical_prefixes: dict[str, str] | None = None, collapse: bool = True, key: str | None = None,
                  digests: dict[str, Column] | None = None) -> DataFrame:
    """Distinct triples ``(s, p, o, o_kind)`` of a mapping over named sources.

    ``frames`` is keyed by source path (``$.buildings.point[*]`` is ``buildings.point``). With ``collapse``,
    records equal in the columns the mapping uses become one before they are expanded: many hourly rows
    of a device then cost one expansion. IRIs are valid in any case: see :func:`coded`.

    ``key`` names a column of a single source that all others the mapping uses are ``digests`` of: hex digests, so different for different
    keys and valid in an IRI as they are, given as expressions of it. Then only distinct keys are shuffled, not all triples.
    """
    by_source: dict[str, list[Rule]] = {}
    for rule in mapping_rules(mapping, canonical_prefixes):
        by_source.setdefault(rule.source, []).append(rule)
    made: DataFrame | None = None
    if key and len(by_source) == 1:
        (source, rules), = by_source.items()
        made = _keyed_triples(frames[source], rules, key, digests or {}, encode)
        if made is not None:
            return made.where(F.col("s").isNotNull() & F.col("o").isNotNull())
    for source, rules in by_source.items():
        df = frames[source]
        records = df.select(*[quoted(c) for c in _used_columns(df, rules)])
        if collapse:
            records = records.distinct()
        texts = _iri_texts(df, rules, encode)
        ready = {reference: f"__iri{k}" for k, reference in enumerate(texts)}
        records = records.selectExpr("*", *[f"{text} as __iri{k}" for k, text in enumerate(texts.values())])
        triples = records.selectExpr(f"inline(flatten(array({', '.join(_triples(df, rule, encode, ready) for rule in rules)})))")
        made = triples if made is None else made.unionByName(triples)
    return made.where(F.col("s").isNotNull() & F.col("o").isNotNull()).distinct()
