"""boxframe: bounding-box image datasets as Spark DataFrame operators.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns); no function holds a global session.
"""

__version__ = "0.1.0"
