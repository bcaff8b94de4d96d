"""graphmill — graph analytics over plain edge tables on Spark DataFrames.

Every operator takes and returns DataFrames.  Edge tables use the columns
``src BIGINT, dst BIGINT`` and optionally ``weight DOUBLE``; vertex results
use ``id BIGINT`` plus value columns.  Iterative operators keep their state
as DataFrames and cut lineage by writing each round to the folder named by
``spark.checkpoint.dir`` (see :mod:`graphmill.functions.state`).
"""

__version__ = "0.1.0"
