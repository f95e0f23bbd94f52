"""Many phrases in one reading of each text.

``instr`` reads a text once for every phrase. Here all phrases of all lists
are one Aho-Corasick automaton (a fixed dictionary of a few hundred phrases,
sent to every task), which finds every occurrence of every phrase, overlaps
and phrases inside phrases included, in one pass. The pass gives the set of
phrases found; which list they count for, repeats in a list, and the rules of
relevance are column expressions on that set, so a row's own language picks
its list after the pass and no join is needed.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.relevance import CONTEXT, IRRELEVANT
from quern.session import ship_package


class Phrases:
    """The distinct phrases of several lists; a list is an array of their numbers, order and repeats kept."""

    def __init__(self, *lists: list[str]):
        self.phrases = sorted({p for ps in lists for p in ps})
        self.number = {p: i for i, p in enumerate(self.phrases)}

    def numbers(self, ps: list[str]) -> Column:
        return F.array(*[F.lit(self.number[p]) for p in ps]).cast("array<int>")

    def text(self, number: Column) -> Column:
        return F.get(F.array(*[F.lit(p) for p in self.phrases]), number)


def find_phrases(df: DataFrame, text: str, phrases: list[str], out: str = "found") -> DataFrame:
    """``df`` with ``out``: the numbers (rising) of the ``phrases`` that stand in the lower-cased text.

    A phrase counts wherever its lower-cased form is a substring, as with
    ``instr``; the empty phrase is found in any text. A null text is empty.
    """
    ship_package(df.sparkSession)
    # Spark lower-cases both sides, so that one rule holds for text and phrases.
    one = df.sparkSession.range(1).select(*[F.lower(F.lit(p)).alias(str(i)) for i, p in enumerate(phrases)]).first()
    by_form: dict[str, list[int]] = {}
    for i, form in enumerate(one or []):
        by_form.setdefault(form, []).append(i)
    always = by_form.pop("", [])
    low = df.withColumn("_low", F.lower(F.coalesce(F.col(text), F.lit(""))))
    field = pa.field(out, pa.list_(pa.int32()))

    def run(batches):
        import ahocorasick
        machine = ahocorasick.Automaton()
        for form, numbers in by_form.items():
            machine.add_word(form, tuple(numbers))
        machine.make_automaton()
        for b in batches:
            found = []
            for x in b.column("_low"):
                hits = set(always)
                if by_form:
                    for _, numbers in machine.iter(x.as_py()):
                        hits.update(numbers)
                found.append(sorted(hits))
            keep = [i for i, n in enumerate(b.schema.names) if n != "_low"]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + [pa.array(found, field.type)],
                                             schema=pa.schema([b.schema.field(i) for i in keep] + [field]))

    return low.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def relevance_by_list(df: DataFrame, lists: dict[str, list[str]], lang: str = "lang", text: str = "text", default: str = "en",
                      irrelevant: list[str] = IRRELEVANT, context: list[str] = CONTEXT) -> DataFrame:
    """B5/C15/E5 for every row by its language's list, from one reading of its text.

    Adds ``hits`` (the list's terms found, in list order, repeats kept),
    ``relevant`` and ``reason``, as ``term_hits``, ``is_relevant`` and
    ``relevance_reason`` give them one phrase at a time.
    """
    all_ = Phrases(*lists.values(), irrelevant, context)
    x = find_phrases(df, text, all_.phrases, "_found")
    own = F.coalesce(*[F.when(F.col(lang) == k, all_.numbers(v)) for k, v in lists.items()], all_.numbers(lists[default]))
    present = lambda ns: F.filter(ns, lambda i: F.array_contains("_found", i))
    x = x.withColumn("_own", own).withColumn("_hits", present(F.col("_own")))
    m = F.size("_hits")
    bad, good = F.size(present(all_.numbers(irrelevant))), F.size(present(all_.numbers(context)))
    none = F.col(text).isNull() | (F.col(text) == "") | (F.size("_own") == 0)
    reason = (F.when(none, "empty").when(m == 0, "none").when(bad > 2, "irrelevant").when(m >= 2, "multi")
              .when(good >= 1, "single_context").otherwise("single_no_context"))
    x = x.withColumn("reason", reason).withColumn("relevant", F.col("reason").isin("multi", "single_context"))
    return x.withColumn("hits", F.transform("_hits", all_.text)).drop("_found", "_own", "_hits")
