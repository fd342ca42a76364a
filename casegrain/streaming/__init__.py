"""casegrain.streaming"""
