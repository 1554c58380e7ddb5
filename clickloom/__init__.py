"""clickloom: clickstream recommendation analytics as Spark DataFrame functions.

Every public operator is a function ``DataFrame -> DataFrame`` (plus plain
parameters). Nothing is collected to the driver except tiny scalar results
used to steer iterative loops (k-core convergence) or gates.
"""

__version__ = "0.1.0"
