"""Training-data operators: scoring, filtering, deduplication, decontamination, chat formatting and mixing."""
