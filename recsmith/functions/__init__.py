"""recsmith.functions"""
