"""Explicit schemas of the files that pipelines read and write; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_A = T.ArrayType
REFERENCE = _struct(type=_S, title=_S, url=_S, date=_S)
CITATION = _struct(reference_id=_I, offset=_I)
PARAGRAPH = _struct(id=_I, text=_S, sentence_offsets=_A(_A(_I)), citations=_A(CITATION))
SECTION = _struct(id=_I, headings=_A(_S), paragraphs=_A(PARAGRAPH))
DOCUMENT = _struct(url=_S, canonical_url=_S, date=_S, title=_S, offset=_I, paragraphs=_A(_A(_S)))

WIKITEXT = _struct(title=_S, page_id=_L, wikitext=_S)
CATEGORIES = _struct(title=_S, page_id=_L, categories=_A(_S))
WIKI_HTML = _struct(title=_S, page_id=_L, html=_S)
#: JSON maps have string keys; ``sources.jsonl.read_articles`` casts them.
ARTICLES = _struct(title=_S, page_id=_L, sections=_A(SECTION), references=T.MapType(_S, REFERENCE))
URLS = _struct(url=_S)
LOCATIONS = _struct(canonical_url=_S, filename=_S, length=_L, offset=_L)
REFERENCE_HTML = _struct(canonical_url=_S, html=_S)
DOCUMENTS = _struct(canonical_url=_S, text=_S, title=_S, date=_S, canonicalLink=_S, paragraphs=_A(_A(_S)))
INSTANCES = _struct(id=_S, page_title=_S, page_id=_L, headings=_A(_S), documents=_A(DOCUMENT), context=_A(_S), cloze=_A(_S))
WORD_FREQUENCY = _struct(word=_S, df=_L)
CORPUS_STATS = _struct(num_documents=_L, avg_document_length=_D)
VIEWS = _struct(page_title=_S, page_id=_L, views=_L)
BM25 = _struct(id=_S, bm25s=_A(_D))
SAMPLE = _struct(id=_S, instance_id=_S, page_title=_S, page_id=_L, headings=_A(_S), document_index=_I, document=_A(_A(_S)), context=_A(_S), cloze=_A(_S), sentence=_S)
GOLD = T.StructType([*SAMPLE.fields, T.StructField("label", _I)])
PR = _struct(precision=_D, recall=_D, f1=_D, threshold=_D)
FINAL = _struct(id=_S, page_title=_S, page_id=_L, headings=_A(_S), documents=_A(DOCUMENT), left_context=_A(_S), cloze=_S, right_context=_A(_S))
CDX_JSON = _struct(status=_S, filename=_S, length=_S, offset=_S)
INDEX_ENTRY = _struct(key=_S, success=_B, data=_S)
