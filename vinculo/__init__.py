"""vinculo: link a roster of people to a public company registry on Spark.

The package is organised by kind of work:

* ``functions``  Column -> Column building blocks (text, documents, dates, name similarity)
* ``operators``  DataFrame -> DataFrame building blocks (conforming, nesting, fuzzy and window joins)
* ``sources``    roster files, registry files, file manifests, index pages
* ``sinks``      silver, gold and lineage writers
* ``plans``      the composed dataflows (partners, roster, links, companies, founders, gold)
* ``streaming``  incremental intake of newly landed files
* ``catalogue``  the registered queries with their SQL counterparts
"""
