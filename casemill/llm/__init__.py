"""Training-data operators: archives, URL filters, language, dedup, quality,
mixing, token files and decontamination.  Nothing else in the library imports
this subpackage; its queries are in `casemill.llm.queries`."""
