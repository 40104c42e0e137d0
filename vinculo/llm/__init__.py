"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

* ``recompression``   exact removal of repeated word windows (operator 1)
* ``search``          exact BM25 top-k over a sharded index with block maxima (operator 2)
* ``line_chunks``     removal of repeated content-defined runs of lines (operator 3, native)
* ``token_files``     token ids in range-coded block files (operator 4)
* ``decontaminate``   benchmark passages found with a suffix automaton (operator 5)
* ``suffix_dedup``    exact removal of repeated byte strings with a hash-compared suffix sort (operator 6)
* ``url_models``      Markov-model URL filter (operator 7, native)
* ``language``        language identification with bit-sliced Bloom filters (operator 8)
* ``simhash``         near-duplicate groups from tiled exact fingerprint comparison (operator 9)
* ``bpe``             byte-pair encoding over a pair occurrence index (operator 10)
* ``alignment``       two tokenizers' tokens linked by pointer jumping (operator 11)
* ``resampling``      importance resampling towards a target distribution (operator 12)
* ``secrets``         secrets, and weak parts of credentials found together (operator 13, native)
* ``queries``         the registered queries and their SQL
"""
