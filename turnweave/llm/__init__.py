"""Training-data operators: quality, near duplicates, classifiers, PII, licences, tokens, chat, HTML, decontamination."""
