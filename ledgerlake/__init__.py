"""ledgerlake — a Spark-native retail medallion engine.

Raw merchant and card-transaction sources are landed (Bronze), cleaned and
conformed (Silver), joined without fan-out (Gold), and then questioned through
named, lazily evaluated ``DataFrame -> DataFrame`` operators.

Sub-packages
------------
``functions``  Column-expression builders (lenient casts, timestamp parsing,
               exact money sums, labels, the installment profit model).
``sources``    Raw-source readers, the driver test-data adapters and table I/O.
``operators``  Cleaning, joining, ranking, question, association and
               data-quality operators.
``plans``      Layer jobs (Bronze → Silver → Gold) and the query registry.
``streaming``  Incremental (Structured Streaming) form of the Gold layer.

Nothing here builds a session, collects to the driver or runs a Python UDF:
every operator returns a lazy DataFrame whose plan Catalyst optimises.
"""

__version__ = "0.1.0"
