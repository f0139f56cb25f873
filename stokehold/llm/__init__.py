"""Training-data operators: quality rules, packing, chat formatting,
decontamination, line and near-duplicate removal, LM scoring, a quality
classifier, pseudonyms and HTML extraction. Nothing outside imports this
subpackage; its queries are in ``llm.queries``."""
