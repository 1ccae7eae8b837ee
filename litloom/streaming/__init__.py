"""litloom.streaming"""
