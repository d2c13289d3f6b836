"""End-to-end plans: lazy DataFrames from decoded records to de-duplicated fragments, contacts and RNA matrices."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contacts, fragments, intervals, phasing, qc, rna

#: Names that users give and read (fixed values), like those of the modes in ``rna_plan``.
EXPERIMENTS = ("atac", "cuttag", "hic", "rna")


@dataclass(frozen=True)
class Settings:
    """Parameters of the plans; a bad value is an error when the settings are made."""

    min_mapq: int = 20
    min_base_quality: int = 20
    rna_mapq: int = 30
    fragment_gap: int = 1
    both_ends: bool = True
    pair_distance: int = 500
    sex_threshold: str = "0.015"
    bin_width: int = 5000
    experiment: str = "cuttag"
    resolutions: tuple[str, ...] = ("20k", "50k", "200k")

    def __post_init__(self) -> None:
        if self.experiment not in EXPERIMENTS:
            raise ValueError(f"experiment is one of {', '.join(EXPERIMENTS)}, not {self.experiment}")
        if len(set(self.resolutions)) != len(self.resolutions):
            raise ValueError("a resolution is named twice")
        if min(self.min_mapq, self.min_base_quality, self.rna_mapq, self.fragment_gap, self.pair_distance) < 0 or self.bin_width <= 0:
            raise ValueError("bounds are not negative and the bin width is positive")


#: What a run's configuration must say where it says anything about these (fixed values).
FROZEN = {
    "cuttag_fragments": {
        "definition": "r2_5prime_unclipped_v2_no_hickit_gate",
        "min_mapq": 20,
        "min_baseq": 20,
        "require_original_r2_qstart_bp": 0,
        "allow_opposite_end_clipping": True,
        "phase_policy": "direct_r2_then_first_phased_r1",
        "endpoint_dedup_eps_bp": 1,
    },
    "rna_gene_compatibility": {
        "min_mapq": 30,
        "feature_type": "gene",
        "feature_id": "gene_id",
        "allow_overlapping_gene_loci": True,
        "overlap_connected_components": True,
        "r1_strand": 1,
        "r2_strand": 2,
    },
}
#: Choices of a configuration (fixed values).
RNA_OUTPUTS, ALIGN_ENDS = ("r1_all", "r1_compatible", "r1r2_concordant"), ("Local", "EndToEnd")


def checked_config(config: dict) -> dict:
    """The configuration of a run, with its choices without blanks around them; anything but the frozen values and the known choices is an error."""
    for section, wanted in FROZEN.items():
        found = config.get(section) or {}
        for key, value in wanted.items():
            if found.get(key) != value or type(found.get(key)) is not type(value):
                raise ValueError(f"{section}.{key} must be {value!r}, not {found.get(key)!r}")
    ends = str(config.get("rna_align_ends_type", "Local")).strip()
    if ends not in ALIGN_ENDS:
        raise ValueError(f"rna_align_ends_type is one of {', '.join(ALIGN_ENDS)}, not {ends!r}")
    kinds = config.get("rna_output_types")
    if not isinstance(kinds, list) or not kinds:
        raise ValueError(f"rna_output_types is a list of some of {', '.join(RNA_OUTPUTS)}")
    kinds = [str(k).strip() for k in kinds]
    if len(set(kinds)) != len(kinds) or not set(kinds) <= set(RNA_OUTPUTS):
        raise ValueError(f"rna_output_types are different ones of {', '.join(RNA_OUTPUTS)}, not {', '.join(kinds)}")
    primary = str(config.get("rna_primary_output_type", "")).strip()
    if primary not in kinds:
        raise ValueError(f"rna_primary_output_type is one of the chosen rna_output_types, not {primary!r}")
    return {**config, "rna_align_ends_type": ends, "rna_output_types": kinds, "rna_primary_output_type": primary}


def read_config(spark: SparkSession, path: str) -> dict:
    """A configuration file, JSON or (where a YAML reader is installed) YAML, from wherever Spark reads; anything but a mapping is an error."""
    row = spark.read.text(path, wholetext=True).first()
    text = row["value"] if row else ""
    try:
        found = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError as missing:
            raise ValueError(f"{path} is no JSON, and no YAML reader is installed") from missing
        found = yaml.safe_load(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no mapping")
    return found


def config_of(spark: SparkSession, path: str, overlays: list[str] | None = None, entries: list[str] | None = None) -> dict:
    """The configuration in ``path`` with the files of ``overlays`` laid over it in order, then ``KEY=VALUE`` entries, checked."""
    config = read_config(spark, path)
    for over in overlays or []:
        config = overlaid(config, read_config(spark, over))
    return checked_config(with_values(config, entries or []))


def overlaid(base: dict, over: dict) -> dict:
    """Nested settings with values of ``over`` in place of those of ``base``."""
    return {k: overlaid(base[k], over[k]) if isinstance(base.get(k), dict) and isinstance(over.get(k), dict) else over.get(k, base.get(k)) for k in {**base, **over}}


def with_values(base: dict, entries: list[str]) -> dict:
    """Settings with ``KEY=VALUE`` entries in place of their values; a value is JSON where it can be read so, else a text."""
    out = dict(base)
    for entry in entries:
        key, equals, value = entry.partition("=")
        if not equals or not key.isidentifier():
            raise ValueError(f"not KEY=VALUE with a name as key: {entry!r}")
        try:
            out[key] = json.loads(value)
        except ValueError:
            out[key] = value
    return out


def settings_of(base: dict, *overlays: dict, entries: list[str] | None = None) -> Settings:
    """Settings from nested dictionaries, laid over one another in order, then ``KEY=VALUE`` entries; an unknown name is an error."""
    for over in overlays:
        base = overlaid(base, over)
    values = with_values(base, entries or [])
    unknown = set(values) - {f.name for f in fields(Settings)}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return Settings(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def fragment_plan(alignments: DataFrame, snps: DataFrame, s: Settings, ties: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Alignments (qname, origin, flag, mapq, q_start, chrom, start, end, strand, cell, cigar, seq, qual) to fragments.

    Only alignments of reads whose chosen R2 is not clipped are phased, so the range join sees no others.  An alignment is known by all of
    its columns, so two that differ in any have votes of their own; rows that are equal in all have the same votes.
    """
    good = fragments.with_aligned_length(alignments.where(fragments.mapped(s.min_mapq)))
    good = good.withColumn("id", F.md5(F.to_json(F.struct(*alignments.columns)).cast("binary")))
    chosen = fragments.unclipped(fragments.select_best(good, ties=ties))
    wanted = good.join(chosen.select("qname"), "qname", "left_semi").dropDuplicates(["id"])
    phased = phasing.phase_alignments(wanted, snps, s.min_base_quality).drop("n0", "n1", "other")
    selected = chosen.join(phased.select("id", "phase"), "id").drop("id")
    phased = phased.drop("id")
    table = fragments.with_fallback_phase(selected, phased, ties)
    kept = fragments.dedup_endpoints(selected, ["cell", "chrom"], ["qname", "start", "end"], s.fragment_gap, s.both_ends)
    cohort = fragments.cohort_fragments(kept)
    return {"phase_table": table, "fragments": kept, "cohort": cohort, "rates": fragments.duplication_rate(selected, kept, "cell"), "bins": intervals.bin_counts(cohort, ["cell", "chrom"], s.bin_width)}


def contact_plan(hits: DataFrame, par: DataFrame | None, s: Settings, ties: tuple[str, ...] = (), male: bool = True) -> dict[str, DataFrame]:
    """Hits of reads to filtered, de-duplicated contacts; ``par`` regions go only for males."""
    reads = contacts.standard_reads(contacts.resolve_reads(hits, ties), contacts.STANDARD if male else contacts.NO_Y)
    if male and par is not None:
        reads = contacts.without_regions(reads, par)
    pairs = contacts.adjacent_pairs(reads)
    kept = contacts.dedup_pairs(pairs, ["chr1", "chr2", "strand1", "strand2"], ["pos2", "qname", "i"], s.pair_distance)
    return {"reads": reads, "pairs": pairs, "deduplicated": kept}


def rna_plan(pairs: DataFrame, components: DataFrame, cells: list, s: Settings) -> dict[str, DataFrame]:
    """Read pairs (cell, umi, g1, g2, r2_mapped) to classes, matrices of three modes and their summaries."""
    tokens = components.select("gene_id", "tokens")

    def with_tokens(d: DataFrame, genes: str, out: str) -> DataFrame:
        each = d.select("pair", F.explode(genes).alias("gene_id")).join(tokens, "gene_id", "left")
        own = F.coalesce("tokens", F.array(F.concat(F.lit("gene:"), "gene_id")))
        t = each.select("pair", F.explode(own).alias("t")).groupBy("pair").agg(F.collect_set("t").alias(out))
        return d.join(t, "pair", "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))

    d = with_tokens(with_tokens(pairs, "g1", "t1"), "g2", "t2").withColumn("category", rna.compatibility())
    modes = {"r1_all": d, "r1_compatible": d.where(~F.col("category").isin("r2_genome_only", "incompatible")), "r1r2_concordant": d.where("category = 'concordant'")}
    out = {"classes": rna.compatibility_counts(d)}
    for name, m in modes.items():
        counts = rna.unique_umis(m.where(F.size("g1") > 0).withColumn("gene", F.array_join("g1", ",")), ["cell", "gene"])
        out[f"matrix_{name}"] = rna.wide_matrix(counts, cells)
        out[f"fractions_{name}"] = rna.split_multigene(counts, ["cell"])
        out[f"summary_{name}"] = rna.matrix_summary(rna.matrix_per_cell(counts))
    return out


def sex_plan(alignments: DataFrame, s: Settings) -> DataFrame:
    return qc.sex_call(qc.flag_counts(alignments, ["cell"], s.min_mapq, s.rna_mapq), s.sex_threshold)
