"""larder: saved cooking pages in, clean recipe tables out, as Spark jobs."""

__version__ = "0.1.0"
