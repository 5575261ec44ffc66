"""DataFrame operators the reference needs beyond single Spark calls."""
