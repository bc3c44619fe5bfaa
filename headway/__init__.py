"""Public-transport analytics on Spark: feeds -> staging -> marts -> reports."""
