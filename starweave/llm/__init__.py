"""Training-data operators: near and exact dedup, archives, personal data,
token counts, packing, toxicity and source mixing.

Nothing outside this subpackage imports it. Every operator takes DataFrames
and returns DataFrames; the registered queries over the given tables live in
``starweave.llm.queries``.
"""
