"""Training-data operators: deduplication, scans, counting, scoring, formatting,
packing and decontamination of document tables. Nothing outside this folder
imports it; ``__spark_entry__`` adds its queries when it is present."""
