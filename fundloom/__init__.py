"""Spark-native analytics over a graph of research funding and output."""
