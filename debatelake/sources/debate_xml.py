"""Debate XML to paragraphs: a depth-first walk with its section context."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

_BLANK = re.compile("[\x80-\x9f\xa0\\s]+")
_LEVELS = ("Section", "SousSection1", "SousSection2")
_SKIPPED = frozenset(("Sommaire", "Quantiemes"))


def _clean(text: str | None) -> str:
    return _BLANK.sub(" ", text or "").strip()


def _tag(node: ElementTree.Element) -> str:
    return node.tag.rpartition("}")[2] if isinstance(node.tag, str) else ""


def _text(node: ElementTree.Element, without: str = "") -> str:
    """All text of a node, but for the leading text of children of one kind."""

    def parts(n):
        if not (n is not node and _tag(n) == without):
            yield n.text or ""
        for child in n:
            yield from parts(child)
            yield child.tail or ""

    return _clean("".join(parts(node)))


def _named(node: ElementTree.Element, name: str) -> Iterator[ElementTree.Element]:
    return (n for n in node.iter() if _tag(n) == name)


def _speakers(para: ElementTree.Element) -> list[dict]:
    out = []
    for o in _named(para, "Orateur"):
        name = next((t for n in _named(o, "Nom") if (t := _text(n))), None) or _text(o)
        role = ";".join(t for tag in ("Qualite", "role") for n in _named(o, tag) if (t := _text(n)))
        attributes = {k.rpartition("}")[2]: v for n in (o, *_named(o, "Nom")) for k, v in n.attrib.items()}
        out.append({"attributes": list(attributes.items()), "Nom": name, "role": role or None, "gender": attributes.get("gender")})
    return out


def _title(node: ElementTree.Element) -> str | None:
    """The first non-empty title among a section's own children."""
    return next((t for n in node if _tag(n).startswith("Titre") and (t := _text(n))), None)


def paragraphs(root: ElementTree.Element) -> list[dict]:
    """Paragraphs in document order, each with the titles of the sections around it."""
    out: list[dict] = []

    def walk(node, context):
        tag = _tag(node)
        if tag == "Para":
            if text := _text(node, "Orateur"):
                out.append({"Ident": node.get("Ident"), "Para": text, "Para_clean": text, "section": context[0], "sous_section_1": context[1], "sous_section_2": context[2], "Orateur": _speakers(node)})
            return
        if tag in _LEVELS:
            level, title = _LEVELS.index(tag), _title(node)
            # a section clears what lies under it; its own level keeps the outer title without one
            context = [*context[:level], title or context[level], *[None] * (2 - level)]
        for child in node:
            if _tag(child) not in _SKIPPED:
                walk(child, context)

    walk(root, [None, None, None])
    return out


def document(data: bytes) -> dict | None:
    """A sitting's document; null if the XML is malformed."""
    try:
        root = ElementTree.fromstring(data)
    except ElementTree.ParseError:
        return None
    first = lambda *names: next((t for name in names for n in _named(root, name) if (t := _text(n))), None)
    return {"dateSeance": first("DateSeance", "dateSeance"), "numSeance": first("NumSeance", "NumSeanceJour", "numSeance"), "Para": paragraphs(root)}


_ARROW = pa.schema([
    ("path", pa.string()), ("dateSeance", pa.string()), ("numSeance", pa.string()), ("failed", pa.bool_()),
    ("Para", pa.list_(pa.struct([("Ident", pa.string()), ("Para", pa.string()), ("Para_clean", pa.string()), ("section", pa.string()), ("sous_section_1", pa.string()), ("sous_section_2", pa.string()), ("Orateur", pa.list_(pa.struct([("attributes", pa.map_(pa.string(), pa.string())), ("Nom", pa.string()), ("role", pa.string()), ("gender", pa.string())])))]))),
])


def parse_debates(files: DataFrame) -> DataFrame:
    """Documents from rows (path, content); malformed ones have ``failed`` and no paragraphs."""

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                doc = document(data.as_py() or b"")
                yield pa.RecordBatch.from_pylist([{"path": path, "failed": doc is None, **(doc or {"dateSeance": None, "numSeance": None, "Para": []})}], schema=_ARROW)

    return files.select("path", "content").mapInArrow(run, f"path string, dateSeance string, numSeance string, failed boolean, Para array<{schemas.PARAGRAPH}>")


def sitting_numbers(files: DataFrame) -> DataFrame:
    """File name and sitting number, natively; malformed XML must have been left out."""
    xml = F.decode("content", "UTF-8")
    number = F.xpath_string(xml, F.lit('//*[local-name()="NumSeance" or local-name()="NumSeanceJour"][1]'))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.nullif(F.trim(number), F.lit("")).alias("numSeance")).where("numSeance is not null")


def output_name(path: Column, day: Column) -> Column:
    """``speech_text_<day>.json`` under the sitting's numeric directory, if there is one."""
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    when = F.coalesce(F.nullif(F.regexp_extract(day, r"(\d{8}|\d{4}-\d{2}-\d{2})", 1), F.lit("")), F.nullif(F.regexp_extract(stem, r"(\d{8})", 1), F.lit("")), stem)
    folder = F.regexp_extract(path, r"/(\d+)/[^/]+$", 1)
    name = F.concat(F.lit("speech_text_"), when, F.lit(".json"))
    return F.when(folder != "", F.concat_ws("/", folder, name)).otherwise(name)
