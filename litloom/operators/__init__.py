"""litloom.operators"""
