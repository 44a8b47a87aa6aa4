"""Training-data operators: dedup, classifiers, filters, decontamination and packing over documents.

Nothing else in the library imports this package. Every operator is a function of DataFrames; the thin
``opN_<name>`` queries and their SQL are in ``pricelens.llm.queries``.
"""
