"""Row types of the engine's relations."""

from __future__ import annotations

NUCLEOTIDES = ("A", "T", "G", "C")
RANKS = ("domain", "phylum", "class", "order", "family", "genus", "species")
PROFILE = "contig string, position bigint, ref_base string, total_coverage bigint, A bigint, C bigint, G bigint, T bigint, N bigint, gene_id string"
METADATA = "sample_id string, replicate string, subjectID string, time string, `group` string"
MAG_SAMPLES = "sample_id string, subjectID string, time string, `group` string, replicate string, file_path string"
CONTIGS = "contig string, seq string"
GENES = "gene_id string, start bigint, end bigint, contig string"
READS = "sample_id string, read_name string, flag int, contig string, pos bigint, mapq int, cigar string, seq string, qual array<int>"
TAXONOMY_RAW = "user_genome string, classification string"
SNV = "scaffold string, position bigint, position_coverage bigint, A bigint, C bigint, T bigint, G bigint"
LEGACY_METADATA = "sample string, diet string, mouse string"
COPY_METADATA = "sample string, time string, `group` string"
