"""Accent folding and entity annotations: the only Python code that runs on rows here, in Arrow batches."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,type:string,text:string,canonical_id:string>>"
_WORD = "0-9A-Za-zÀ-ÿ"


def fold_with_places(text: str) -> tuple[str, list[int]]:
    """Folded text, and for each of its characters the place in the original; one more for the end."""
    out, places = [], []
    for i, c in enumerate(text):
        for x in unicodedata.normalize("NFKD", c):
            if not unicodedata.combining(x):
                folded = x.casefold()
                out.append(folded)
                places += [i] * len(folded)
    return "".join(out), [*places, len(text)]


def fold_text(text: str) -> str:
    return fold_with_places(text)[0]


def annotate_text(content: str | None, entities) -> list[dict]:
    """Flat spans of entity names in content: earlier first, then longer, then more frequent."""
    if not content:
        return []
    folded, places = fold_with_places(content)
    found = []
    for order, e in enumerate(entities if entities is not None else []):
        name = fold_text(e["text"] or "").split()
        if not name:
            continue
        pattern = re.compile(rf"(?<![{_WORD}])" + r"\s+".join(map(re.escape, name)) + rf"(?![{_WORD}])")
        for m in pattern.finditer(folded):
            start, end = places[m.start()], places[m.end() - 1] + 1
            found.append((start, start - end, -(e["count"] or 0), order, end, e))
    spans, reach = [], 0
    for start, _, _, _, end, e in sorted(found, key=lambda x: x[:4]):
        if start >= reach:
            spans.append({"start": start, "end": end, "type": (e["type"] or "").strip().upper(), "text": content[start:end], "canonical_id": e["canonical_id"]})
            reach = end
    return spans


def _fold_all(texts: pd.Series) -> pd.Series:
    return texts.map(fold_text, na_action="ignore")


def _annotate_all(content: pd.Series, entities: pd.Series) -> pd.Series:
    return pd.Series([annotate_text(c, e) for c, e in zip(content, entities, strict=True)], dtype=object)


def source_digest(content: str | None, entities) -> str:
    """sha256 over the content and the entity fields that annotations depend on."""
    own = [{k: (int(e[k]) if k == "count" and e[k] is not None else e[k]) for k in ("canonical_id", "count", "text", "type")} for e in (entities if entities is not None else [])]
    return hashlib.sha256(json.dumps({"content": content or "", "entities": own}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def _digest_all(content: pd.Series, entities: pd.Series) -> pd.Series:
    return pd.Series([source_digest(c, e) for c, e in zip(content, entities, strict=True)], dtype=object)


# Workers import this module without a session, so the UDFs are made where they are used.


def accent_fold(text) -> Column:
    return F.pandas_udf(_fold_all, "string")(text)


def annotations(content, entities) -> Column:
    return F.pandas_udf(_annotate_all, SPAN)(content, entities)


def source_hash(content, entities) -> Column:
    return F.pandas_udf(_digest_all, "string")(content, entities)
