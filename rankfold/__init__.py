"""rankfold: document retrieval and ranking evaluation as Spark DataFrame jobs.

Every operator takes DataFrames and returns a lazy DataFrame; nothing is
collected to the driver except one-row statistics and size checks.
"""

__version__ = "0.1.0"
