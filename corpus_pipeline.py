"""A training corpus from raw documents: five stages, each written and read again before the next.

A stage takes (spark, docs, sf_dir). All but the last return the columns of `docs` and keep what they do not reject:
1. toxicity: documents that score as toxic go;
2. line_dedup: frequent lines stay in one document only;
3. shingle_join: one document of each group of near copies stays;
4. decontamination: documents that hold a benchmark item go;
5. byte_bpe: token counts and digests of ids and of the decoded text.
"""

from pyspark.sql import DataFrame, SparkSession

from moraflow.llm import bpe, decontamination, line_dedup, shingle_join, toxicity
from moraflow.llm.queries import BYTE_BPE
from moraflow.llm.texts import table, written

STAGES = [
    ("toxicity", lambda spark, docs, sf_dir: toxicity.accepted(docs, table(spark, sf_dir, "labels"))),
    ("line_dedup", lambda spark, docs, sf_dir: line_dedup.without_repeats(docs)),
    ("shingle_join", lambda spark, docs, sf_dir: shingle_join.one_of_each(docs)),
    ("decontamination", lambda spark, docs, sf_dir: decontamination.clean(docs, table(spark, sf_dir, "benchmark"))),
    ("byte_bpe", lambda spark, docs, sf_dir: bpe.encode_and_decode(docs, BYTE_BPE)),
]

#: The fitted classifier of the first stage is not expressible in SQL; tests compare the run with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
