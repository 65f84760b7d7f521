"""textlab: distributed labelled-text analytics on PySpark.

Every public operator is a function from DataFrame(s) to a DataFrame. Nothing
is collected to the driver; the only driver-side values are parameters and
scalar results of bounded size (e.g. a rule list capped by ``max_features``).
"""

__version__ = "0.1.0"
