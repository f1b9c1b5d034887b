"""Reading entity files: locating them, finding blobs, decoding blobs, and the two Spark entry points."""
