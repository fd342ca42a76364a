"""The operators that SQL cannot express, on small fixed tables whose results are stated in SQL; the tables given play no part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrain.llm.canonical import map_values
from casegrain.llm.leaks import find_leaks
from casegrain.llm.lookalikes import make_consistent, representatives
from casegrain.llm.pii import replace_personal
from casegrain.plans.registry import Registry

R = Registry()


def values_sql(rows: list[tuple], columns: str) -> str:
    say = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(say, r)) + ")" for r in rows) + f") v({columns})"


FORMS = [
    ("ＣＴ ｓｃａｎ", "CT scan"), ("re\u0301sume\u0301", "résumé"), ("soft\u00adhy\u200bphen", "softhyphen"), ("a\u00a0b\u2009c", "a b c"), ("X\u2011ray", "X-ray"), ("ﬁrst", "first"), ("МRІ of thе liνer", "MRI of the liver"),
    ("е\u0301cole", "école"), ("e\u0302\u0323", "ệ"), ("\u1112\u1161\u11ab\u1100\u116e\u11a8", "한국"), ("TNFα, IFNγ – IL-1β", "TNFα, IFNγ – IL-1β"), ("Редкое наблюдение", "Редкое наблюдение"), ("plain  text", "plain  text"), ("", ""), (None, None),
]


@R.query("p1_examples", values_sql([(i, b) for i, (_, b) in enumerate(FORMS)], "id, consistent"))
def p1_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(FORMS)], "id int, value string")
    return make_consistent(df, "value", "consistent", representatives({chr(c): 1 for c in range(32, 127)})).select("id", "consistent")


NAMES = [("m", "computed tomography", 1), ("m", "CT", 1), ("m", "magnetic resonance imaging", 2), ("m", "MRI", 2), ("a", "breast", 5), ("a", "urinary bladder", 6), ("d", "breast carcinoma", 7), ("d", "optic neuritis", 8), ("d", "ON", 8)]
ENTERED = [
    ("m", "Computed  Tomography", 1), ("m", "computde tomograpy", 1), ("m", "tomography, computed", 1), ("m", "ct scan", 1), ("m", "contrast CT of thorax", 1), ("m", "mri scan", 2), ("m", "mganetic resonance imaging (follow-up)", 2), ("m", "see notes on file", -1), ("m", "?", -1),
    ("a", "bladder, urinary", 6), ("a", "left breast", 5), ("a", "elbow", -1), ("d", "carcinoma of the breast", 7), ("d", "neuritis of the optic", 8), ("d", "found on day two", -1), ("z", "breast", -1),
]


@R.query("p2_examples", values_sql(ENTERED, "field, value, entry"))
def p2_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = spark.createDataFrame([(f, v) for f, v, _ in ENTERED] + [("m", None), ("m", "  ")], "field string, value string")
    return map_values(values, spark.createDataFrame(NAMES, "field string, name string, entry long")).select("field", "value", F.col("entry").cast("int").alias("entry"))


ITEM = "the quick surgeon moved seven old chairs across a narrow yellow corridor while nobody in the crowded waiting room noticed how carefully each broken wheel had been wrapped in blue paper before dawn".split()
TEXTS = [
    (1, " ".join(ITEM), True), (2, "before it " + " ".join(ITEM[:27]).upper() + " and after", True), (3, " ".join(w + "," for w in ITEM), True), (4, " ".join("odd" if i % 9 == 8 else w for i, w in enumerate(ITEM)), True), (5, " ".join(ITEM[:20]), False),
    (6, " ".join(sorted(ITEM)), False), (7, " ".join(ITEM[:14] + ["(see", "the", "long", "note", "below)"] + ITEM[14:]), True), (8, "", False), (9, None, False), (10, "nothing of it", False), (11, "x alpha beta gamma y", False),
]


@R.query("p6_examples", values_sql([(d, 1) for d, _, hit in TEXTS if hit] + [(11, 2)], "doc_id, item_id"))
def p6_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.createDataFrame([(d, t) for d, t, _ in TEXTS], "doc_id int, text string")
    items = spark.createDataFrame([(1, " ".join(ITEM)), (2, "Alpha, beta: gamma"), (3, "")], "item_id int, text string")
    return find_leaks(docs, items).select(F.col("doc_id").cast("int").alias("doc_id"), F.col("item_id").cast("int").alias("item_id"))


PERSONAL = [
    (1, "Please contact Dr. Maria Holbek on +1 212 555 0100 for images.", "Please contact Dr. [NAME] on [PHONE] for images."), (2, "Queries go to maria.holbek(at)clinic(dot)example please.", "Queries go to [EMAIL] please."),
    (3, "Signed: Bo Stavsen, passport no. X01234567. Nothing else.", "Signed: [NAME], passport no. [ID_NUMBER]. Nothing else."), (4, "She lives at 12 Elm Hollow Street, Fernwick ZZ1 2QX with two cats.", "She lives at [ADDRESS] with two cats."),
    (5, "Similar findings were described by Vasko et al. (2013) [5].", "Similar findings were described by Vasko et al. (2013) [5]."), (6, "Lot 999 046 331 of tesprol was used, catalogue no. 555-043.", "Lot 999 046 331 of tesprol was used, catalogue no. 555-043."), (7, "", ""), (8, None, None),
]


@R.query("p7_examples", values_sql([(i, b) for i, _, b in PERSONAL], "doc_id, redacted"))
def p7_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal(spark.createDataFrame([(i, a) for i, a, _ in PERSONAL], "doc_id int, text string")).select("doc_id", "redacted")
