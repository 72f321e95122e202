"""Training-data operators: tokenizing, filtering, deduplicating and packing
text corpora.  Nothing outside this subpackage imports it."""
