"""Fill-in-the-middle and the filter audit against plain Python."""

import hashlib
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from regmill.llm import fill_middle, filter_audit
from pyspark.sql import functions as F

# --- fill-in-the-middle --------------------------------------------------------------------------------


def moved(doc, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n, text = len(units), text or ""
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middle_edges(strange):
    got = fill_middle.fill_in_middle(strange).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    want = [(r.doc_id, *moved(r.doc_id, r.text), r.text or "") for r in strange.collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert fill_middle.fill_in_middle(strange.where("false")).count() == 0


PIECES = st.text(alphabet="ab Zé中\U0001f600<P>SM\n0")


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(0, 10**6))
def test_cuts_are_those_of_units(text, doc):
    made = fill_middle.move_middle(text.encode(), fill_middle.numbers(1, doc))
    assert (made.n, made.form, made.prefix_chars, made.middle_chars, made.output.decode()) == moved(doc, text)


@given(PIECES)
def test_exceptions_convert_both_ways(text):
    raw = text.encode()
    index = fill_middle.Exceptions(np.frombuffer(raw, np.uint8))
    assert len(index.at) == sum(ord(c) > 127 for c in text)
    for k in range(len(text) + 1):
        at = len(text[:k].encode())
        assert index.chars(at) == k and index.bytes(k) == at


# --- filter audit ---------------------------------------------------------------------------------------


def audit(rows, labels):
    """(part, order, step) -> counts; documents go through the filters one by one."""
    good, toxic = ({d for d, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    least = {}
    for doc, text, _ in rows:
        least.setdefault(text or "", []).append((doc is None, doc or 0))
    fails, parts = [], defaultdict(list)
    for k, (doc, text, part) in enumerate(rows):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = "A" if len(words) < 200 else ""
        failed += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        failed += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
        failed += "D" if re.search("[#$%&*|]", text) else ""
        failed += "E" if (doc is None, doc or 0) > min(least[text]) else ""
        fails.append(failed)
        parts[part or ""].append(k)
    out = {}
    for part, members in parts.items():
        total = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            left = members
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                failing = [k for k in members if f in fails[k]]
                total[f] += len(gone)
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    len(failing) - len(gone),
                    sum(fails[k] == f for k in members),
                    sum(rows[k][0] in good for k in gone),
                    sum(rows[k][0] in toxic for k in gone),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(total[order[step - 1]])
    return {key: tuple(v) for key, v in out.items()}


def test_audit_edges(spark, strange):
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, 1), (None, 1, 1), (4, 1, 1), (99, 1, 1), (10, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.filter_audit(strange, table).collect()
    rows = [(r.doc_id, r.text, r.source) for r in strange.collect()]
    want = audit(rows, [x for x in labels if x[0] is not None])
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want and len(got) == 120 * 5 * 4
    assert filter_audit.filter_audit(strange.where("false"), table).count() == 0
    assert filter_audit.filter_audit(strange, table.where("false")).where("good_lost + toxic_lost > 0").count() == 0


def test_contractions_choose_along_each_axis():
    tensor = np.arange(32).reshape([2] * 5)
    table = filter_audit.contractions(tensor)
    assert table[2, 2, 2, 2, 2] == tensor.sum() and table[1, 0, 2, 1, 2] == tensor[1, 0, :, 1, :].sum()
