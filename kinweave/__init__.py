"""Similarity networks, cluster analysis and genome neighbourhoods as Spark DataFrame jobs."""
