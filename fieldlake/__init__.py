"""fieldlake: environmental / event data work expressed as Spark DataFrame functions.

Every public function takes DataFrames (and plain parameters) and returns a
DataFrame; nothing is collected to the driver except single scalar
watermarks and test-report rows.
"""

__version__ = "0.1.0"
