"""tidemark: medallion, data-quality and star-schema operators for PySpark.

Every operator takes and returns DataFrames or Columns, names its columns
through parameters, and leaves the physical strategy to Catalyst.
"""

__version__ = "0.1.0"
