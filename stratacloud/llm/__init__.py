"""Training-data operators over document, page and vector tables.

Nothing outside this folder imports it; it may be removed as a whole.
"""
