"""recsmith.operators"""
