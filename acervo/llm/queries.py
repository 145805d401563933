"""Queries of the training-text problems, with their oracles where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.llm import names, packing, pii, scans, tokens, truncation
from acervo.plans.catalog import Catalog
from acervo.session import spread, table

LLM = Catalog()


@LLM.query("p7_ids")
def p7_ids(spark, sf_dir):
    return tokens.token_ids(spread(table(spark, sf_dir, "documents", "doc_id", "text")))


@LLM.query("p7_resumen")
def p7_resumen(spark, sf_dir):
    """Texts, tokens and characters per token by source."""
    docs = spread(table(spark, sf_dir, "documents", "doc_id", "text", "source", "n_chars"))
    counts = tokens.token_counts(docs, also=("source", "n_chars"))
    return counts.groupBy("source").agg(F.count("*").alias("textos"), F.sum("tokens").alias("tokens"), F.round(F.sum("n_chars") / F.sum("tokens"), 4).alias("caracteres_por_token"))


@LLM.query("p8_contenedores")
def p8_contenedores(spark, sf_dir):
    """Every text of ``documents`` in a container of every kind, with little room left over."""
    counts = tokens.token_counts(spread(table(spark, sf_dir, "documents", "doc_id", "text")))
    return packing.pack(counts, table(spark, sf_dir, "contenedores"))


@LLM.query("p8_llenado")
def p8_llenado(spark, sf_dir):
    """How full the containers are, per kind."""
    return packing.fill_report(p8_contenedores(spark, sf_dir), table(spark, sf_dir, "contenedores"))


@LLM.query("p8_prueba")
def p8_prueba(spark, sf_dir):
    """Per kind of container what must be nought: overfull containers, tokens not placed once, texts divided without need."""
    counts = tokens.token_counts(spread(table(spark, sf_dir, "documents", "doc_id", "text")))
    return packing.proof(counts, table(spark, sf_dir, "contenedores"))


@LLM.query("p9_found")
def p9_found(spark, sf_dir):
    return pii.found_items(spread(table(spark, sf_dir, "documents", "doc_id", "text")))


@LLM.query("p9_textos")
def p9_textos(spark, sf_dir):
    """The texts with each item replaced by a placeholder of its type."""
    return pii.redacted(spread(table(spark, sf_dir, "documents", "doc_id", "text")))


@LLM.query("p9_resumen")
def p9_resumen(spark, sf_dir):
    """Items and texts per type."""
    return pii.item_counts(spread(table(spark, sf_dir, "documents", "doc_id", "text")))


def _entities(spark, sf_dir):
    return names.entities(names.typed_names(table(spark, sf_dir, "circulares", *names.PERSONS, *names.OFFICES)))


@LLM.query("p6_found")
def p6_found(spark, sf_dir):
    return names.pairs(_entities(spark, sf_dir))


@LLM.query("p6_entidades")
def p6_entidades(spark, sf_dir):
    """Each different string with the entity it names and the number of strings of that entity."""
    e = _entities(spark, sf_dir)
    sizes = e.groupBy("campo", "entidad").agg(F.count("*").alias("formas"))
    return e.join(sizes, ["campo", "entidad"])


def _judged(spark, sf_dir):
    return truncation.judged(spread(table(spark, sf_dir, "circulares", "circular_id", "fuente", "materia", "antecedentes")))


@LLM.query("p2_found")
def p2_found(spark, sf_dir):
    return _judged(spark, sf_dir).where("cortado").select("circular_id", "campo")


@LLM.query("p2_tasas")
def p2_tasas(spark, sf_dir):
    """How often each source cuts each column."""
    return truncation.cut_rates(_judged(spark, sf_dir))


@LLM.query("p5_found")
def p5_found(spark, sf_dir):
    return scans.noisy_lines(table(spark, sf_dir, "circulares", "circular_id", *scans.FIELDS))


@LLM.query("p5_textos")
def p5_textos(spark, sf_dir):
    """The three fields as continuous readable paragraphs."""
    return scans.repaired(table(spark, sf_dir, "circulares", "circular_id", *scans.FIELDS))


@LLM.query("p5_resumen")
def p5_resumen(spark, sf_dir):
    """Findings and records per field and kind."""
    return p5_found(spark, sf_dir).groupBy("campo", "clase").agg(F.count("*").alias("lineas"), F.countDistinct("circular_id").alias("registros"))
