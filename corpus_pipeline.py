"""The corpus pipeline: stages over `documents`, each written as Parquet and read by the next. All but the last
return the columns they were given; a stage works on all rows its predecessor kept."""

from tillcast.llm import exact_dedup, line_quality, mixing, packing, simhash
from tillcast.llm.common import table
from tillcast.session import shared_folder


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules reject go; the others stay as they are. Texts count once for a line, or a large group of
    copies would be rejected before exact dedup keeps one of it."""
    return line_quality.keep_documents(docs, distinct_texts=True)


def exact_dedup_stage(spark, docs, sf_dir):
    """One row of each text stays."""
    return exact_dedup.deduplicate(docs)


def near_dedup_stage(spark, docs, sf_dir):
    """One document of each group of near copies stays: fingerprints at two or fewer differing bits, linked by the
    SimHash operator's byte-position index."""
    return simhash.deduplicate(docs)


def mixing_stage(spark, docs, sf_dir):
    """Documents of domains above their target share beside all clean ones are thinned out; none is taken twice."""
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"), most=1.0, whole="clean")


def packing_stage(spark, docs, sf_dir):
    """Pieces of token sequences with their places."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("soft_mixing", mixing_stage),
    ("vector_best_fit", packing_stage),
]

# Fingerprints, the classifier and the packing have no SQL; tests compare the run with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Applies the stages to the documents of `sf_dir`; what lies between two stages goes to the
    session's shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "corpus-pipeline")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
