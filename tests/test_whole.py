"""Queries against plain loops or joins of pandas, beside their SQL."""

import pandas as pd
import pytest

import __spark_entry__ as entry
from cytoflux.operators import adapters
from cytoflux.plans.fixtures import view

SF = "/root/testdata/sf0.001"
ID = ["q", "ln", "price", "chrom", "start", "end"]


def run(spark, name):
    return entry.queries()[name](spark, SF).toPandas()


@pytest.fixture(scope="module")
def tables(spark):
    return {n: view(spark, SF, n).toPandas() for n in ("fragments", "genes", "tss", "contacts", "umis", "cells")}


def rows(frame):
    return sorted(map(tuple, frame.astype(object).where(frame.notna(), None).itertuples(index=False)), key=str)


def pile(tables, flank, cuts=False):
    f, t = tables["fragments"].copy(), tables["tss"]
    if cuts:
        f = pd.concat([f.assign(site=f["start"]), f.assign(site=f["end"] - 1)])
    else:
        f["site"] = [s + 4 if d == "+" else e - 5 for s, e, d in zip(f["start"], f["end"], f["strand"], strict=True)]
    m = f[["cell", "chrom", "site"]].merge(t, on="chrom")
    m["off"] = (m["site"] - m["pos"]).where(m["strand"] == "+", m["pos"] - m["site"])
    return m[m["off"].abs() <= flank]


def test_tss_profile_score(spark, tables):
    m, cells = pile(tables, 1000, cuts=True), sorted(set(tables["fragments"]["cell"]))
    of = {c: m.loc[m["cell"] == c, "off"] for c in cells}
    flank = {c: (o.abs() > 900).sum() / 200 for c, o in of.items()}
    mean = sum(flank.values()) / len(cells)
    got = run(spark, "tss_profile_score").set_index("cell")
    assert sorted(got.index) == cells and got["insertions"].sum() == len(m)
    for c, o in of.items():
        assert got.loc[c, "insertions"] == len(o)
        if len(o):
            assert got.loc[c, "tss_score"] == pytest.approx(o.between(-501, 499).sum() / 1001 / (flank[c] or mean), abs=1e-8)


def test_bulk_tss_signal(spark, tables):
    m = pile(tables, 2000)
    n = ((m.loc[m["off"] < 2000, "off"] + 2000) // 10).value_counts().to_dict()
    noise = sum(v for k, v in n.items() if k < 10 or k >= 390) / 20
    got = run(spark, "bulk_tss_signal")
    assert dict(zip(got["bin"], got["n"], strict=True)) == n
    for signal, k in zip(got["signal"], got["n"], strict=True):
        assert pd.isna(signal) if noise == 0 else signal == pytest.approx(k / noise, abs=1e-8)


def test_overlap_semi_counts(spark, tables):
    m = tables["fragments"].merge(tables["tss"][["chrom", "pos"]], on="chrom")
    m = m[(m["start"] < m["pos"] + 20) & (m["pos"] - 20 < m["end"])].groupby("chrom")["pos"].agg(["size", "nunique"])
    assert rows(run(spark, "overlap_semi_counts")[["chrom", "hits", "windows"]]) == rows(m.reset_index())


def test_overlap_anti(spark, tables):
    f = tables["fragments"][ID]
    m = f.reset_index().merge(tables["genes"][["chrom", "start", "end"]], on="chrom", suffixes=("", "_g"))
    hit = set(m.loc[(m["start"] < m["end_g"]) & (m["start_g"] < m["end"]), "index"])
    assert rows(run(spark, "overlap_anti")[ID]) == rows(f[~f.index.isin(hit)])


def test_overlap_fraction_filter(spark, tables):
    bases = {}
    for c, s, e in zip(*(tables["genes"][k] for k in ("chrom", "start", "end")), strict=True):
        bases.setdefault(c, set()).update(range(s, e + 25))
    f = tables["fragments"][ID].drop_duplicates()
    n = [sum(p in bases.get(c, ()) for p in range(s, e)) for c, s, e in zip(f["chrom"], f["start"], f["end"], strict=True)]
    keep = [not (k >= 30 and k >= 0.5 * (e - s)) for k, s, e in zip(n, f["start"], f["end"], strict=True)]
    assert rows(run(spark, "overlap_fraction_filter")[ID]) == rows(f[keep])


def test_cell_qc_metadata(spark, tables):
    got, c, u = run(spark, "cell_qc_metadata").set_index("cell"), tables["contacts"], tables["umis"]
    assert sorted(got.index) == sorted(tables["cells"]["cell"])
    for cell in got.index:
        mine = c[c["cell"] == cell]
        want = (len(mine), len(mine), (mine["chr1"] != mine["chr2"]).sum(), (u["cell"] == cell).sum())
        assert tuple(got.loc[cell, ["dna_reads", "pairs", "inter_pairs", "rna_reads"]]) == want
    assert (got["rna_reads"] > 0).any() and (got.loc[got["dna_reads"] > 0, "pairs_per_read"] == 1).all()


def test_split_read_totals(spark, tables):
    c = tables["contacts"]
    want = pd.crosstab(c["q"], c["ln"] % 3).reset_index()
    got = run(spark, "split_read_totals")
    assert rows(got[["q", "reads_0", "reads_1", "reads_2"]].fillna(0).astype(int)) == rows(want.astype(int))


def test_adapter_match_keeps_the_whole_text(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")["text"].str.upper()
    got = run(spark, "adapter_match").set_index("doc_id")
    assert sorted(got.index) == sorted(d.index) and d.str.len().max() > 60 and got["matched"].any()
    for k, text in d.items():
        cut = adapters.prefix_errors(text, "THERNTION", 0.25, 4)
        assert got.loc[k, "matched"] == (cut is not None) and got.loc[k, "trimmed"] == text[cut or 0 :]


def test_adapter_argmax(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").toPandas()["text"]
    want = {k: int(texts.str.contains(a, regex=False).sum()) for k, a in (("a", "thing"), ("b", "ation"), ("c", "queue"))}
    assert entry.queries()["adapter_argmax"](spark, SF).first().asDict() == {**want, "best": max(sorted(want), key=want.get)}


def test_directional_umi(spark):
    """Every group's clusters by a plain search from the most frequent UMI on."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet").toPandas()
    groups: dict = {}
    for order, supplier, part in zip(li["l_orderkey"], li["l_suppkey"], li["l_partkey"], strict=True):
        umi = "".join("ACGT"[(order >> 2 * k) & 3] for k in range(11, -1, -1))
        counts = groups.setdefault((supplier % 50, part % 5), {})
        counts[umi] = counts.get(umi, 0) + 1
    want = {}
    for key, counts in groups.items():
        seen, n = set(), 0
        for u in sorted(counts, key=lambda x: (-counts[x], x)):
            if u in seen:
                continue
            n, todo = n + 1, [u]
            seen.add(u)
            while todo:
                a = todo.pop()
                for b in {a[:i] + c + a[i + 1 :] for i in range(12) for c in "ACGT"} & counts.keys() - seen:
                    if counts[a] >= 2 * counts[b] - 1:
                        seen.add(b)
                        todo.append(b)
        want[key] = n
    got = run(spark, "directional_umi")
    assert {(c, g): n for c, g, n in zip(got["cell"], got["gene"], got["n"], strict=True)} == want


def test_rmsd_queries(spark):
    """The best three and all loci of the query's structures, by numpy."""
    import itertools

    import numpy as np

    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    shapes: dict = {}
    for vec, x in zip(e["vec_id"], e["embedding"], strict=True):
        locus = vec // 15
        shapes.setdefault(vec // 5 % 3, {}).setdefault(vec % 5, {})[locus] = np.array([float(x[k]) + 3 * np.sin(locus * (k + 1)) for k in range(3)])
    loci = {(x.cell, x.pos): x.rmsd for x in entry.queries()["rmsd_per_locus"](spark, SF).collect()}
    best = {x.cell: x for x in entry.queries()["rmsd_best3"](spark, SF).collect()}
    for cell, s in shapes.items():
        common = sorted(set.intersection(*(set(x) for x in s.values())))
        d = {}
        for i, j in itertools.combinations(range(5), 2):
            a, b = (np.stack([s[k][p] for p in common]) for k in (i, j))
            a, b = a - a.mean(axis=0), b - b.mean(axis=0)
            u, _, v = np.linalg.svd(b.T @ a)
            d[i, j] = np.linalg.norm(b @ u @ v - a, axis=1)
        per = np.sqrt((np.stack(list(d.values()), axis=1) ** 2).mean(axis=1))
        assert np.allclose([loci[cell, p] for p in common], per, atol=1e-6)
        three = min(itertools.combinations(range(5), 3), key=lambda t: sum(np.median(d[p]) for p in itertools.combinations(t, 2)))
        rms = [np.sqrt((d[p] ** 2).mean()) for p in itertools.combinations(three, 2)]
        assert np.allclose(tuple(best[cell])[1:], (5, len(common), np.sqrt((per**2).mean()), np.median(per), np.sqrt(np.mean(np.square(rms))), np.median(rms)), atol=1e-6)
