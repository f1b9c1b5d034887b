"""Operators for preparing training data: language, quality, licences, near copies, packing, chat."""
