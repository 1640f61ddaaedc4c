"""Readers and writers: landing files, pages, published weeks, queues, caches."""
