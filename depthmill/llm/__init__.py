"""Corpus preparation: packing, token files, scoring, scans, de-duplication and decontamination of documents."""
